"""Personal data by fixed patterns and a skip-chain conditional random field.

Four patterns give the base spans, which always stay.  The field runs over the
tokens of a document that hold a digit or an at sign; other words enter as
context.  Neighbouring tokens share a chain potential, and tokens of a document
that repeat or share their digits or their local part share a skip potential, so
that what one occurrence shows clearly, the others follow.  Marginals come from
loopy message passing; tokens labelled beyond the base spans become added spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import saved, whole_text

# The patterns' kinds, in the order spans are listed.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^ \t\n\r\f\v]+")
_MARK = re.compile(r"[0-9@]")

LABELS = 1 + len(KINDS)
FEATURES = 1 << 12
# Tokens the field is fitted on, at most; documents are taken in the order of their hash.
TRAINING_TOKENS = 20_000
STEPS = 8  # rounds of message passing
MIN_MARGINAL = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    parts = text.split(".")
    digits = all(p.isascii() and p.isdigit() for p in parts)
    return len(parts) == 4 and digits and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; leftmost, without overlap inside a kind."""
    found = [(0, *span) for span in _emails(text)]
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m.group())]
    found += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m.group())]
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# --- the graph ---------------------------------------------------------------


class Nodes:
    """Candidate tokens of one document: cores, places, features, edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.spans: list[tuple[int, int]] = []
        self.features: list[list[int]] = []
        self.gold: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        ordered = sorted((a, b, k + 1) for k, a, b in base)
        last: dict[str, int] = {}
        before, before_node, waiting, at = "", False, None, 0
        for m in _TOKEN.finditer(text):
            token = m.group()
            if waiting is not None:
                self.features[waiting].append(_feature("after", _shape(token)))
                waiting = None
            if not _MARK.search(token):
                before, before_node = token, False
                continue
            begin = m.start() + len(token) - len(token.lstrip(".,;:!?\"'#$%&*<>[]{}|"))
            core = token.strip(".,;:!?\"'#$%&*<>[]{}|")
            n = len(self.spans)
            self.spans.append((begin, begin + len(core)))
            self.features.append([*_features(core), _feature("before", _shape(before))])
            while at < len(ordered) and ordered[at][1] <= begin:
                at += 1
            label = next((k for a, b, k in ordered[at : at + 4] if a < begin + len(core) and b > begin), 0)
            self.gold.append(label)
            if before_node:
                self.chain.append((n - 1, n))
            for key in _likeness_keys(core):
                if key in last and (last[key], n) not in self.skip[-4:]:
                    self.skip.append((last[key], n))
                last[key] = n
            before, before_node, waiting = token, True, n


def _shape(token: str) -> str:
    shape = re.sub(r"[0-9]+", "0", re.sub(r"[^\W\d_]+", "a", token[:64]))
    return shape[:12]


def _feature(kind: str, value: object) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) % FEATURES


def _features(core: str) -> list[int]:
    digits = _digits(core[:4096])
    return [
        _feature("bias", 1),
        _feature("shape", _shape(core)),
        _feature("digits", min(len(digits), 24)),
        _feature("length", min(len(core), 40) // 2),
        _feature("first", core[:1] if not core[:1].isalpha() else "a"),
        _feature("at", "@" in core and "." in core.rpartition("@")[2]),
        _feature("ip", _is_ip(core)),
        _feature("card", len(core) < 64 and _is_card(core)),
        _feature("only", core.isdigit()),
    ]


def _likeness_keys(core: str) -> list[str]:
    """What links a token to the last one of its document that is equal or similar."""
    keys = ["=" + core]
    digits = _digits(core)
    if len(digits) >= 7:
        keys.append("#" + digits)
    if "@" in core:
        keys.append("@" + core.partition("@")[0].lower())
    return keys


# --- the field ----------------------------------------------------------------


class Field:
    """Weights of the tokens' features, and of label pairs along chain and skip edges."""

    def __init__(self):
        self.unary = np.zeros((FEATURES, LABELS))
        self.chain = np.zeros((LABELS, LABELS))
        self.skip = np.zeros((LABELS, LABELS))

    def fit(self, features: list[list[int]], gold: np.ndarray, around: np.ndarray, steps: int = 150) -> None:
        """Pseudo-likelihood by gradient steps: each label given its neighbours' labels.

        ``around`` has the labels before, after, skipped to before and after; -1: none.
        """
        n = len(gold)
        rows = np.repeat(np.arange(n), [len(f) for f in features])
        columns = np.concatenate([np.array(f) for f in features])
        one = np.eye(LABELS)
        sides = [(around[:, 0], "chain", False), (around[:, 1], "chain", True), (around[:, 2], "skip", False), (around[:, 3], "skip", True)]
        squares = {name: np.full_like(getattr(self, name), 1e-3) for name in ("unary", "chain", "skip")}
        for _ in range(steps):
            z = np.zeros((n, LABELS))
            np.add.at(z, rows, self.unary[columns])
            for label, name, turned in sides:
                has = label >= 0
                pair = getattr(self, name)
                z[has] += (pair.T if turned else pair)[label[has]]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - one[gold]) / n
            gradients = {name: 1e-4 * getattr(self, name) for name in squares}
            np.add.at(gradients["unary"], columns, error[rows])
            for label, name, turned in sides:
                has = label >= 0
                g = np.zeros((LABELS, LABELS))
                np.add.at(g, label[has], error[has])
                gradients[name] = gradients[name] + (g.T if turned else g)
            for name, g in gradients.items():
                squares[name] = 0.9 * squares[name] + 0.1 * g * g
                setattr(self, name, getattr(self, name) - 0.1 * g / np.sqrt(squares[name] + 1e-10))

    def marginals(self, documents: list[Nodes]) -> list[np.ndarray]:
        """Label marginals of each document's tokens, by loopy message passing over all of them at once."""
        sizes = [len(d.spans) for d in documents]
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        n = int(offsets[-1])
        if not n:
            return [np.zeros((0, LABELS)) for _ in documents]
        theta = np.zeros((n, LABELS))
        features = [f for d in documents for f in d.features]
        rows = np.repeat(np.arange(n), [len(f) for f in features])
        np.add.at(theta, rows, self.unary[np.concatenate([np.array(f) for f in features])])
        edges = [(o + a, o + b, t) for d, o in zip(documents, offsets) for t, e in enumerate((d.chain, d.skip)) for a, b in e]
        belief = theta
        if edges:
            one, two, kind = np.array(edges, dtype=np.int64).T
            pair = np.stack([self.chain, self.skip])[kind]
            source, target = np.concatenate([one, two]), np.concatenate([two, one])
            psi = np.concatenate([pair, pair.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(one)) + len(one), np.arange(len(one))])
            message = np.zeros((len(source), LABELS))
            for _ in range(STEPS):
                belief = theta.copy()
                np.add.at(belief, target, message)
                sent = (belief[source] - message[back])[:, :, None] + psi
                top = sent.max(axis=1)
                fresh = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
                message = 0.5 * message + 0.5 * (fresh - fresh.max(axis=1, keepdims=True))
            belief = theta.copy()
            np.add.at(belief, target, message)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return [p[a:b] for a, b in zip(offsets, offsets[1:])]


def _plausible(kind: int, text: str) -> bool:
    digits = len(_digits(text))
    if kind == 0:
        return "@" in text[1:] and "." in text.partition("@")[2]
    if kind == 1:
        return _is_ip(text)
    if kind == 2:
        return _is_card(text)
    return 7 <= digits <= 15


def added_spans(text: str, base: list[tuple[int, int, int]], nodes: Nodes, marginals: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of neighbouring tokens of one label that touch no base span and can be of that kind.

    Cards, addresses and mail addresses are single tokens; only phones join.
    """
    taken = np.zeros(len(nodes.spans), bool)
    ordered = sorted((a, b) for _, a, b in base)
    at = 0
    for i, (begin, end) in enumerate(nodes.spans):
        while at < len(ordered) and ordered[at][1] <= begin:
            at += 1
        taken[i] = any(a < end and b > begin for a, b in ordered[at : at + 4])
    linked, found, run = set(nodes.chain), [], []

    def close() -> None:
        if run:
            kind, begin, end = run[0][0], run[0][1], run[-1][2]
            if _plausible(kind, text[begin:end]):
                found.append((kind, begin, end))
            run.clear()

    for i, (begin, end) in enumerate(nodes.spans):
        label = int(marginals[i].argmax())
        if taken[i] or not label or marginals[i][label] < MIN_MARGINAL:
            close()
            continue
        if run and (run[0][0] != label - 1 or label != 4 or (i - 1, i) not in linked):
            close()
        run.append((label - 1, begin, end))
    close()
    return found


# --- Spark --------------------------------------------------------------------


def _training_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {"hash": [], "at": [], "features": [], "gold": [], "around": []}
        for h, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            nodes = Nodes(text, base_spans(text))
            around = np.full((len(nodes.spans), 4), -1)
            for a, b in nodes.chain:
                around[b, 0], around[a, 1] = nodes.gold[a], nodes.gold[b]
            for a, b in nodes.skip:
                around[b, 2], around[a, 3] = nodes.gold[a], nodes.gold[b]
            for i, features in enumerate(nodes.features):
                for column, value in zip(rows.values(), (h, i, features, nodes.gold[i], around[i].tolist())):
                    column.append(value)
        types = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))


def train(texts: DataFrame, tokens: int = TRAINING_TOKENS) -> Field | None:
    """A field fitted to the base spans of at most ``tokens`` candidate tokens; None without any.

    Documents come in the order of their hash, so the sample is the same each time.
    """
    hashed = texts.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("hash"), "text")
    rows = hashed.mapInArrow(_training_tokens, "hash long, at int, features array<int>, gold int, around array<int>")
    sample = saved(rows.orderBy("hash", "at").limit(tokens), "pii-tokens").toPandas()
    if sample.empty:
        return None
    field = Field()
    field.fit([list(f) for f in sample["features"]], sample["gold"].to_numpy(), np.array(sample["around"].tolist()))
    return field


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added) per row of ``docs`` (doc_id, text).

    Counts and hash are of the base spans; ``spans`` lists all, ``added`` says how
    many the field put in.  Null text counts as empty; other columns are ignored;
    repeated rows give equal rows.  Without ``field`` one is fitted on ``docs``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    field = field or train(rows.select("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    # Texts without digit or at sign hold nothing and stay out of the Python workers.
    shown = rows.select("doc_id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                yield _searched(batch.slice(begin, 1000), shared.value)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, added long"
    return shown.mapInArrow(search, schema)


def _searched(batch: pa.RecordBatch, field: Field | None) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column(1).to_pylist()]
    bases = [base_spans(t) for t in texts]
    nodes = [Nodes(t, b) for t, b in zip(texts, bases)]
    if field is None:
        added: list[list] = [[] for _ in texts]
    else:
        added = [added_spans(*x) for x in zip(texts, bases, nodes, field.marginals(nodes))]
    counts = [[sum(k == kind for k, _, _ in b) for b in bases] for kind in range(len(KINDS))]
    hashes = [hashlib.sha256(listed(b).encode()).hexdigest() for b in bases]
    everything = [",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in sorted({*b, *x})) for b, x in zip(bases, added)]
    columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(hashes, pa.string())]
    columns += [pa.array(everything, pa.string()), pa.array([len(x) for x in added], pa.int64())]
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "added"]
    return pa.RecordBatch.from_arrays(columns, names)
