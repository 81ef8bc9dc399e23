"""SentencePiece encoding and decoding with the N best segmentations.

A text's lattice has an edge for every piece of the vocabulary that matches; a
path's score is the sum of its pieces' scores.  Where no piece can cross, before a
run of spaces and around newlines, the lattice falls into segments, so the best
path is the segments' best paths.  Forward Viterbi gives the best score to every
place of a segment.  The N best paths of a segment come from an A-star search
backward from its end, for which those scores are exact estimates of what is
still to come; the N best of the text combine the segments that lose least.
Paths of equal score stand in the order of their ids from the end, in Viterbi as in
the search.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import whole_text

BEST = 4
# Code points encoded together in a task, and the longest segment that goes the array way.
CHUNK_CHARS = 4_000_000
ARRAY_LENGTH = 24
SPACE = "▁"  # fixed value: how pieces write a space
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A vocabulary: scored pieces, the ids of single bytes, and what each id decodes to."""

    def __init__(self, model: bytes):
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.scores: dict[str, tuple[int, float]] = {}
        self.bytes = [-1] * 256
        self.unknown = source.unk_id()
        self.decoded: list[bytes] = []
        for i in range(source.get_piece_size()):
            piece = source.id_to_piece(i)
            if source.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.decoded.append(bytes([value]))
            elif source.is_control(i) or source.is_unknown(i) or source.is_unused(i):
                self.decoded.append(b"")
            else:
                self.scores[piece] = (i, float(source.get_score(i)))
                self.decoded.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.scores), default=1)
        # A character outside the vocabulary is spelt in bytes, at a score below every piece's.
        self.spelt = min((s for _, s in self.scores.values()), default=0.0) - 10.0
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores) or any("\n" in p for p in self.scores)
        self.segment = re.compile(r"(?s).+" if crossing else rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.tables = []
        for length in range(1, min(self.longest, ARRAY_LENGTH) + 1):
            same = [p for p in self.scores if len(p) == length]
            keys = _rolled(np.array([[ord(c) for c in p] for p in same], np.uint64).reshape(-1, length), length)[:, 0]
            order = np.argsort(keys)
            ids = np.array([self.scores[p][0] for p in same], np.int64)
            values = np.array([self.scores[p][1] for p in same], np.float64)
            self.tables.append((keys[order], ids[order], values[order]))

    # --- one segment ----------------------------------------------------------

    def _edges(self, text: str, end: int) -> Iterator[tuple[int, float, tuple[int, ...]]]:
        """(start, score, ids) of the edges that end at ``end``."""
        for start in range(max(0, end - self.longest), end):
            known = self.scores.get(text[start:end])
            if known:
                yield start, known[1], (known[0],)
        if text[end - 1] not in self.scores:
            yield end - 1, self.spelt, self._spell(text[end - 1])

    def _spell(self, c: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] if self.bytes[b] >= 0 else self.unknown for b in c.encode("utf-8", "surrogatepass"))

    def forward(self, text: str) -> list[float]:
        """The best score of any path from the start to each place."""
        best = [0.0] + [float("-inf")] * len(text)
        for end in range(1, len(text) + 1):
            best[end] = max((best[start] + score for start, score, _ in self._edges(text, end)), default=float("-inf"))
        return best

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths of a segment, best first; equal scores by their ids from the end."""
        best = self.forward(text)
        queue: list = [(-best[-1], (), len(text), 0.0)]
        found = []
        while queue and len(found) < n:
            estimate, ids, place, behind = heapq.heappop(queue)
            if not place:
                found.append((-estimate, tuple(reversed(ids))))
                continue
            for start, score, new in self._edges(text, place):
                entry = (-(best[start] + score + behind), (*ids, *reversed(new)), start, score + behind)
                heapq.heappush(queue, entry)
        return found

    # --- many segments ----------------------------------------------------------

    def top_two(self, segments: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of each segment: ids of its best path, that path's score, and how much the second loses."""
        ids: list = [None] * len(segments)
        score, loss = np.zeros(len(segments)), np.full(len(segments), np.inf)
        by_length: dict[int, list[int]] = {}
        for i, s in enumerate(segments):
            by_length.setdefault(len(s) if len(s) <= ARRAY_LENGTH else 0, []).append(i)
        slow = by_length.pop(0, [])
        for length, members in by_length.items():
            slow += self._same_length([segments[i] for i in members], length, members, ids, score, loss)
        for i in slow:
            paths = self.n_best(segments[i], 2)
            ids[i], score[i] = np.array(paths[0][1], np.int32), paths[0][0]
            loss[i] = paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf
        return ids, score, loss

    def _same_length(self, texts, length, members, ids, score, loss) -> list[int]:
        """Viterbi over segments of one length at once; returns those with characters to be spelt."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length).astype(np.uint64)
        n = len(codes)
        first, second = np.full((n, length + 1), -np.inf), np.full((n, length + 1), -np.inf)
        back, piece = np.zeros((n, length + 1), np.int64), np.full((n, length + 1), -1, np.int64)
        first[:, 0] = 0.0
        found = []
        for size in range(1, min(length, len(self.tables)) + 1):
            keys, table_ids, values = self.tables[size - 1]
            rolled = _rolled(codes, size)
            if not len(keys):
                found.append((np.full(rolled.shape, -1), np.full(rolled.shape, -np.inf)))
                continue
            at = np.minimum(np.searchsorted(keys, rolled.ravel()), len(keys) - 1)
            hit = keys[at] == rolled.ravel()
            found.append(
                (np.where(hit, table_ids[at], -1).reshape(rolled.shape), np.where(hit, values[at], -np.inf).reshape(rolled.shape))
            )
        odd = (found[0][0] < 0).any(axis=1)
        for end in range(1, length + 1):
            for size in range(1, min(end, len(found)) + 1):
                start = end - size
                value = found[size - 1][1][:, start]
                one, two = first[:, start] + value, second[:, start] + value
                new = found[size - 1][0][:, start]
                # Of equal scores the smaller last id stays: the order in which the search from the end finds paths.
                better = (one > first[:, end]) | ((one == first[:, end]) & (new >= 0) & (new < piece[:, end]))
                second[:, end] = np.maximum(np.maximum(second[:, end], two), np.where(better, first[:, end], one))
                first[:, end] = np.where(better, one, first[:, end])
                back[:, end] = np.where(better, size, back[:, end])
                piece[:, end] = np.where(better, new, piece[:, end])
        place, steps = np.full(n, length), []
        rows = np.arange(n)
        usable = ~odd
        while (place[usable] > 0).any():
            steps.append(np.where(place > 0, piece[rows, place], -1))
            place = np.maximum(place - np.maximum(back[rows, place], 1), 0)
        path = np.stack(steps[::-1], axis=1) if steps else np.zeros((n, 0), np.int64)
        lengths = (path >= 0).sum(axis=1)
        flat = path[path >= 0].astype(np.int32)
        cuts = np.concatenate(([0], np.cumsum(lengths)))
        where = np.array(members)
        score[where] = first[:, length]
        with np.errstate(invalid="ignore"):
            loss[where] = np.where(np.isfinite(second[:, length]), first[:, length] - second[:, length], np.inf)
        for k in np.flatnonzero(usable).tolist():
            ids[members[k]] = flat[cuts[k] : cuts[k + 1]]
        return [members[k] for k in np.flatnonzero(odd).tolist()]

    # --- texts --------------------------------------------------------------------

    def segments(self, text: str) -> list[str]:
        """The text with a space in front and spaces as pieces write them; a literal sign of that kind stands apart."""
        if not text:
            return []
        if SPACE in text:
            return [s for i, part in enumerate(text.split(SPACE)) for s in ([""] if i else []) + self._plain(part, i == 0)]
        return self._plain(text, True)

    def _plain(self, text: str, opening: bool) -> list[str]:
        return self.segment.findall((SPACE if opening else "") + text.replace(" ", SPACE))

    def encode(self, texts: list[str], n: int = BEST) -> Iterator[tuple[np.ndarray, float, list[dict]]]:
        """Best ids, their score, and the next best segmentations of each text.

        Those are given as (score, edits); an edit (at, gone, ids) puts ``ids`` in the
        place of ``gone`` pieces of the best path from ``at`` on.
        """
        index: dict[str, int] = {}
        spread = [np.fromiter((index.setdefault(s, len(index)) for s in self.segments(t)), np.int64) for t in texts]
        listed = list(index)
        signs = np.array(self._spell(SPACE), np.int32)
        known = [s for s in listed if s]
        ids, score, loss = self.top_two(known)
        if "" in index:  # stands for a literal sign, spelt in bytes
            at = index[""]
            ids.insert(at, signs)
            score, loss = np.insert(score, at, self.spelt), np.insert(loss, at, np.inf)
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1] if len(sizes) else sizes
        paths: dict[int, list] = {}
        for order in spread:
            counts = sizes[order]
            begins = np.concatenate(([0], np.cumsum(counts)))
            places = np.repeat(starts[order] - begins[:-1], counts) + np.arange(begins[-1])
            total = float(score[order].sum())
            yield flat[places], total, self._next_best(order, listed, loss, begins, total, paths, n)

    def _next_best(self, order, listed, loss, begins, total, paths, n) -> list[dict]:
        if n < 2 or not len(order):
            return []
        losses = loss[order]
        few = min(n - 1, len(order))
        cut = np.partition(losses, few - 1)[few - 1]
        below = np.flatnonzero(losses < cut)
        chosen = sorted([*below.tolist(), *np.flatnonzero(losses == cut)[: few - len(below)].tolist()])
        chosen = [i for i in chosen if np.isfinite(losses[i])]
        options = []
        for i in chosen:
            word = int(order[i])
            if word not in paths:
                paths[word] = self.n_best(listed[word], n)
            options.append(paths[word])
        drops = [[o[0][0] - s for s, _ in o] for o in options]
        seen, queue, found = {(0,) * len(options)}, [(0.0, (0,) * len(options))], []
        while queue and len(found) < n:
            lost, choice = heapq.heappop(queue)
            edits = [
                {"at": int(begins[i]), "gone": int(begins[i + 1] - begins[i]), "ids": list(o[c][1])}
                for i, o, c in zip(chosen, options, choice)
                if c
            ]
            found.append({"score": total - lost, "edits": edits})
            for k, c in enumerate(choice):
                if c + 1 < len(drops[k]):
                    step = (*choice[:k], c + 1, *choice[k + 1 :])
                    if step not in seen:
                        seen.add(step)
                        heapq.heappush(queue, (sum(d[j] for d, j in zip(drops, step)), step))
        return found[1:]

    def decode(self, ids) -> str:
        """The text of ids; the space put in front by encoding is taken off again."""
        text = b"".join(map(self.decoded.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` characters from each place on, row by row."""
    width = codes.shape[1] - size + 1
    out = np.zeros((len(codes), width), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ codes[:, k : k + width]) * _STEP
            out ^= out >> np.uint64(29)
    return out


def model_bytes(path: str) -> bytes:
    """The vocabulary file, read by the driver and sent to the tasks (its size is that of a vocabulary)."""
    with open(path, "rb") as file:
        return file.read()


_EDITS = pa.list_(pa.struct([("at", pa.int32()), ("gone", pa.int32()), ("ids", pa.list_(pa.int32()))]))
_NEXT = pa.list_(pa.struct([("score", pa.float64()), ("edits", _EDITS)]))
SCHEMA = (
    "doc_id long, ids array<int>, score double, "
    "next_best array<struct<score: double, edits: array<struct<at: int, gone: int, ids: array<int>>>>>, round_trip boolean"
)


def encode_documents(docs: DataFrame, model: bytes, best: int = BEST) -> DataFrame:
    """(doc_id, ids, score, next_best, round_trip) per row of ``docs`` (doc_id, text); other columns are ignored.

    ``ids`` is the best segmentation, ``next_best`` the next ``best`` - 1 as edits of
    it, best first; ``round_trip`` says whether the ids decode to the whole text.
    Null text counts as empty, which has no ids and score 0; repeated rows give
    equal rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            begin, chars = 0, 0
            texts = batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                chars += len(text)
                if chars >= CHUNK_CHARS or i + 1 == len(texts):
                    yield _encoded(pieces, batch.column(0).slice(begin, i + 1 - begin), texts[begin : i + 1], best)
                    begin, chars = i + 1, 0

    return rows.mapInArrow(encode, SCHEMA)


def _encoded(pieces: Pieces, doc_ids: pa.Array, texts: list[str], best: int) -> pa.RecordBatch:
    ids, scores, following, same = [], [], [], []
    for text, (found, score, others) in zip(texts, pieces.encode(texts, best)):
        ids.append(found)
        scores.append(score)
        following.append(others)
        same.append(pieces.decode(found.tolist()) == text)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
    columns = [doc_ids, pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(scores, pa.float64())]
    columns += [pa.array(following, _NEXT), pa.array(same, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "score", "next_best", "round_trip"])


def _decode(model_shared):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model_shared.value)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return decode


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of ``encoded`` (doc_id, ids); null ids give null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(shared), "doc_id long, text string")
