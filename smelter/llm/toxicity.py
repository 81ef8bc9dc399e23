"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

One model is learnt from toxic texts, one from ordinary texts.  Both predict each
letter of a word from up to four letters before it, by interpolated absolute
discounting: raw counts for five letters, counts of different left neighbours for
four and three.  Below that both share one model, two letters and one, counted over
all documents, so that rare expressions tell the classes apart only by what the
classes themselves have seen.  Counts are of all documents, of every labelled one for
the class models; each order's go into a table of fixed size by hash, so that what
tasks receive is bounded however much is counted.  A text's evidence is the difference of the two
log-likelihoods per letter, over the whole text and over its strongest windows;
a logistic curve fitted to labelled texts that the models have not seen turns it
into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm.common import saved, small_batches, whole_text

ORDER = 5
SHARED = 2  # orders that both classes share
DISCOUNT = 0.75
# Labelled documents the curve is fitted to at most, the first by hash.
CURVE_DOCS = 6_000
# Cells, as powers of two, of the tables of one class and order, and of the table of single letters.
# Grams that share a cell share their counts; a task holds seven times three tables of 4 MB at most.
GRAM_BITS, LETTER_BITS = 20, 16
BOTH = 2  # stands for both classes, beside 0 and 1
# Words whose evidence a task keeps at hand, and words and texts it works on at once.
CACHE_WORDS = 100_000
WORDS_AT_ONCE, TEXTS_AT_ONCE = 8_192, 100
# Cells, as a power of two, of the table that tells which ids may have a label; 8 MB go to a task.
LABEL_BITS = 26
# Windows, in words, whose strongest average counts beside the whole text.
WINDOWS = (1, 4, 16, 64)
_EDGE = 32  # stands before and after every word


def _word_symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with an edge before each and after the last, and where each word's edge stands."""
    joined = _code_points(" " + " ".join(words) + " ")
    starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)))
    return joined, starts


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _hashes(joined: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the ``length`` symbols that end at each of ``ends``."""
    h = np.full(len(ends), 0x9E3779B97F4A7C15 + length, np.uint64)
    for k in range(length - 1, -1, -1):
        h = (h ^ joined[ends - k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _cell_of(column: str, bits: int) -> Column:
    return F.shiftrightunsigned(column, 64 - bits)


def _places(joined: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Where ``order`` symbols end that lie inside one word, its edges included."""
    places = np.arange(order - 1, len(joined))
    at_edge = np.zeros(len(joined) + 1, np.int64)
    at_edge[starts + 1] = 1
    word = np.cumsum(at_edge)[: len(joined)]  # an edge counts to the word before it; as a start see below
    begin = places - order + 1
    inside = (word[places] == word[begin]) | (np.isin(begin, starts) & (word[places] == word[begin] + 1))
    return places[inside & (places > 0)]


def _marks(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bit for each of the cells, in words of 64, and how many cells there are up to the end of each word."""
    bits = np.zeros(1 << (GRAM_BITS - 6), np.uint64)
    np.bitwise_or.at(bits, cells >> 6, np.uint64(1) << (cells & 63).astype(np.uint64))
    return bits, np.cumsum(np.bitwise_count(bits), dtype=np.int32)


class Level:
    """Discounted counts of one order: of grams, and of what follows their contexts, by cell.

    Held and sent as the cells that are filled; once these would take as much, as whole tables instead.
    """

    def __init__(self, grams: tuple[np.ndarray, ...], contexts: tuple[np.ndarray, ...]):
        """``grams``: cells and counts; ``contexts``: cells, counts, and how many grams each begins."""
        orders = (np.argsort(part[0]) for part in (grams, contexts))
        self.filled = tuple(tuple(a[order] for a in part) for part, order in zip((grams, contexts), orders))
        self.marks, self.counts = None, None

    def __getstate__(self) -> tuple:
        if self.filled is not None:
            return self.filled
        grams, contexts = (np.flatnonzero(t).astype(np.int32) for t in (self.counts, self.totals))
        return (grams, self.counts[grams]), (contexts, self.totals[contexts], self.kinds[contexts])

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def spread(self) -> None:
        if self.filled is not None:
            self.counts, self.totals, self.kinds = (np.zeros(1 << GRAM_BITS, np.float32) for _ in range(3))
            (grams, counts), (contexts, totals, kinds) = self.filled
            self.counts[grams], self.totals[contexts], self.kinds[contexts] = counts, totals, kinds
            self.filled = self.marks = None

    def _numbers(self, part: int, asked: np.ndarray) -> list[np.ndarray]:
        """What the filled cells hold at those asked for, 0 where they are not filled."""
        bits, upto = self.marks[part]
        word, bit = asked >> 6, np.uint64(1) << (asked & 63).astype(np.uint64)
        near = bits[word]
        known = (near & bit) != 0
        place = (upto[word] - np.bitwise_count(near & ~(bit - np.uint64(1))))[known]
        found = [np.zeros(len(asked), np.float32) for _ in self.filled[part][1:]]
        for numbers, held in zip(found, self.filled[part][1:]):
            numbers[known] = held[place]
        return found

    def numbers(self, gram: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of grams, and totals and kinds of contexts, by cell."""
        if self.filled is not None and self.marks is None:
            if sum(a.nbytes for part in self.filled for a in part) >= 3 * 4 << GRAM_BITS:
                self.spread()
            else:
                self.marks = [_marks(part[0]) for part in self.filled]
        if self.filled is None:
            return self.counts[gram], self.totals[context], self.kinds[context]
        return *self._numbers(0, gram), *self._numbers(1, context)

    def probability(self, gram: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
        counts, totals, kinds = self.numbers(gram, context)
        known = totals > 0
        total = np.where(known, totals, 1.0).astype(np.float64)
        count = np.minimum(counts, total)  # more only where a frequent gram shares the cell
        mixed = np.maximum(count - DISCOUNT, 0.0) / total + DISCOUNT * kinds / total * lower
        return np.where(known, mixed, lower)


class Models:
    """The two class models and the curve; tables of bounded size that every task receives."""

    def __init__(self, single: np.ndarray, pair: Level, levels: dict[int, dict[int, Level]]):
        """``single``: counts of letters by cell; ``levels``: by class and order."""
        single = single + 0.01
        self.single, self.pair, self.levels = single / single.sum(), pair, levels
        self.mean, self.scale = np.zeros(len(WINDOWS) + 1), np.ones(len(WINDOWS) + 1)
        self.weights = np.zeros(len(WINDOWS) + 2)

    def evidence(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        if not words:
            return np.zeros(0)
        joined, starts = _word_symbols(words)
        every = np.arange(len(joined))
        shared = self.single[_cells(_hashes(joined, every, 1), LETTER_BITS)]
        places = {order: _places(joined, starts, order) for order in range(SHARED, ORDER + 1)}
        cells = {
            order: (_cells(_hashes(joined, at, order), GRAM_BITS), _cells(_hashes(joined, at - 1, order - 1), GRAM_BITS))
            for order, at in places.items()
        }
        shared[places[SHARED]] = self.pair.probability(*cells[SHARED], shared[places[SHARED]])
        logs = {}
        for c, levels in self.levels.items():
            p = shared.copy()
            for order in range(SHARED + 1, ORDER + 1):
                p[places[order]] = levels[order].probability(*cells[order], p[places[order]])
            logs[c] = np.log(np.maximum(p, 1e-12))
        difference = logs[1] - logs[0]
        difference[0] = 0.0
        total = np.concatenate(([0.0], np.cumsum(difference)))
        return total[starts[1:] + 1] - total[starts[:-1] + 1]

    def features(self, evidence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Evidence per letter: of the strongest windows, and of the whole text."""
        if not len(evidence):
            return np.zeros(len(WINDOWS) + 1)
        e, n = np.concatenate(([0.0], np.cumsum(evidence))), np.concatenate(([0], np.cumsum(lengths)))
        values = []
        for window in WINDOWS:
            w = min(window, len(evidence))
            values.append(((e[w:] - e[:-w]) / (n[w:] - n[:-w])).max())
        return np.array([*values, e[-1] / n[-1]])

    def fit_curve(self, rows: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression with a small ridge, by Newton steps."""
        self.mean, self.scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-9)
        x = np.column_stack([(rows - self.mean) / self.scale, np.ones(len(rows))])
        w, ridge = np.zeros(x.shape[1]), np.diag([1.0] * rows.shape[1] + [1e-6])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (p - labels) + ridge @ w
            w = w - np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, gradient)
        self.weights = w

    def score(self, features: np.ndarray) -> float:
        z = float((features - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Reader:
    """Features of texts, with the evidence of words met before at hand."""

    def __init__(self, models: Models):
        self.models, self.cache = models, {}

    def features(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Features of each text; null counts as empty."""
        for begin in range(0, len(texts), TEXTS_AT_ONCE):
            split = [(t or "").lower().split() for t in texts.slice(begin, TEXTS_AT_ONCE).to_pylist()]
            if len(self.cache) > CACHE_WORDS:
                self.cache = {}
            fresh = list({w for words in split for w in words if w not in self.cache})
            for first in range(0, len(fresh), WORDS_AT_ONCE):
                some = fresh[first : first + WORDS_AT_ONCE]
                self.cache.update(zip(some, self.models.evidence(some).tolist()))
            for words in split:
                evidence = np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))
                lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
                yield self.models.features(evidence, lengths)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, context, letter, n) of the symbol pairs in a task's texts, white space and ends being edges."""
    plain = np.zeros(1 << 14, np.int64)  # pairs of two ASCII symbols
    for batch in batches:
        for begin in range(0, batch.num_rows, TEXTS_AT_ONCE):
            texts = batch.column(0).slice(begin, TEXTS_AT_ONCE).to_pylist()
            s = _code_points(" " + " ".join(texts).lower() + " ").astype(np.int64)
            s[(s >= 9) & (s <= 13)] = _EDGE
            first, second = s[:-1], s[1:]
            ascii_pair = (first | second) < 128
            plain += np.bincount(first[ascii_pair] << 7 | second[ascii_pair], minlength=1 << 14)
            keys, n = np.unique(first[~ascii_pair] << 21 | second[~ascii_pair], return_counts=True)
            yield _pair_rows(keys >> 21, keys & ((1 << 21) - 1), n)
    plain[_EDGE << 7 | _EDGE] = 0
    keys = np.flatnonzero(plain)
    yield _pair_rows(keys >> 7, keys & 127, plain[keys])


def _pair_rows(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    both = np.column_stack([first, second]).astype(np.uint64).ravel()
    ends = np.arange(1, len(both), 2)
    hashed = _hashes(both, ends, 2), _hashes(both, ends - 1, 1), _hashes(both, ends, 1)
    columns = [*(pa.array(h.view(np.int64)) for h in hashed), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["gram", "context", "letter", "n"])


_GRAM_ROW = "toxic int, size int, gram long, context long, tail long, opening boolean, n long"


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of counted words, for every order that the classes do not share; ``opening`` ones begin a word."""
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        for c in (0, 1):
            mine = pa.array(toxic == c)
            words, counts = batch.column(1).filter(mine).to_pylist(), batch.column(2).filter(mine).to_numpy(zero_copy_only=False)
            if not words:
                continue
            joined, starts = _word_symbols(words)
            owner = np.searchsorted(starts, np.arange(len(joined)), side="left") - 1  # the word a place ends in
            for order in range(SHARED + 1, ORDER + 1):
                at = _places(joined, starts, order)
                grams, first, which = np.unique(_hashes(joined, at, order), return_index=True, return_inverse=True)
                n = np.bincount(which, weights=counts[owner[at]], minlength=len(grams)).astype(np.int64)
                at = at[first]
                columns = [
                    *(pa.array(np.full(len(grams), x, np.int32)) for x in (c, order)),
                    *(pa.array(h.view(np.int64)) for h in (grams, _hashes(joined, at - 1, order - 1), _hashes(joined, at, order - 1))),
                    pa.array(joined[at - order + 1] == _EDGE),
                    pa.array(n),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "size", "gram", "context", "tail", "opening", "n"])


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out of all learning."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def _labels(labels: DataFrame, parts: list[int]) -> DataFrame:
    """(label_id, toxic) of the labelled ids with these remainders."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = known.where(remainder(F.col("doc_id")).isin(parts))
    return some.select(F.col("doc_id").alias("label_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))


def _labelled(docs: DataFrame, chosen: DataFrame, parts: list[int]) -> DataFrame:
    """(toxic, text) of the documents with a label."""
    some = docs.select("doc_id", "text").where(remainder(F.col("doc_id")).isin(parts))
    return some.join(chosen, F.col("doc_id").cast("long") == F.col("label_id")).select("toxic", whole_text().alias("text"))


def _label_cell(column: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(column).cast("long")), 64 - LABEL_BITS)


def _label_bits(chosen: DataFrame) -> np.ndarray:
    """A bit per cell, set if an id of ``chosen`` falls into it; the driver gets 64 bits a row, 2^20 rows at most."""
    cells = chosen.select(_label_cell("label_id").alias("cell"))
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = cells.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (LABEL_BITS - 6), np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table


def _packed_labelled(docs: DataFrame, chosen: DataFrame, parts: list[int]) -> DataFrame:
    """:func:`_labelled` where texts are shuffled: without those that cannot have a label, and as zstd.

    The bits let every labelled id through, and a few others, which the join leaves out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_label_bits(chosen))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            batch = batch.filter(pa.array((sent.value[cells >> 6] >> (cells & 63)) & 1 == 1))
            texts = [t.as_buffer() for t in batch.column("text")]
            sizes = pa.array([t.size for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), sizes, pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())],
                ["id", "size", "packed"],
            )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(begin, TEXTS_AT_ONCE)
                sizes, packed = some.column("size").to_pylist(), some.column("packed")
                texts = [codec.decompress(t.as_buffer(), n, asbytes=True) if n else b"" for n, t in zip(sizes, packed)]
                yield pa.RecordBatch.from_arrays([some.column("toxic"), pa.array(texts, pa.binary())], ["toxic", "text"])

    some = docs.select(F.col("doc_id").cast("long").alias("id"), "doc_id", whole_text().alias("text"))
    some = some.where(remainder(F.col("doc_id")).isin(parts) & F.col("id").isNotNull())
    packed = some.select("id", _label_cell("id").alias("cell"), "text").mapInArrow(pack, "id long, size long, packed binary")
    # Without a shuffle between them both functions would run in one task, on two Python workers, which stay.
    joined = packed.join(chosen.hint("merge"), F.col("id") == F.col("label_id")).select("toxic", "size", "packed")
    return joined.mapInArrow(unpack, "toxic int, text binary").select("toxic", F.col("text").cast("string").alias("text"))


def _class_counts(words: DataFrame) -> DataFrame:
    """(toxic, size, gram, context, n) from labelled texts: n are raw counts for the longest
    grams, and for shorter ones counts of different left neighbours; what starts a word has none."""
    split = words.select("toxic", F.explode_outer(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
    counted = split.groupBy("toxic", "word").agg(F.count(F.lit(1)).alias("n")).mapInArrow(_gram_counts, _GRAM_ROW)
    grams = counted.groupBy("toxic", "size", "gram").agg(
        F.first("context").alias("context"), F.first("tail").alias("tail"), F.first("opening").alias("opening"), F.sum("n").alias("n")
    )
    grams = saved(grams, "grams")
    left = grams.groupBy("toxic", (F.col("size") - 1).alias("size"), F.col("tail").alias("gram")).agg(F.count(F.lit(1)).alias("left"))
    raw = (F.col("size") == ORDER) | F.col("opening") | F.col("left").isNull()
    n = F.when(raw, F.col("n")).otherwise(F.col("left")).alias("n")
    return grams.join(left, ["toxic", "size", "gram"], "left").select("toxic", "size", "gram", "context", n)


def _levels(counts: DataFrame) -> dict[tuple[int, int], Level]:
    """Tables by class and order from (toxic, size, gram, context, n); the driver gets cells, never grams."""
    n = F.sum("n").cast("float").alias("n")

    def by(column: str, *sums: Column) -> dict[tuple[int, int], tuple[np.ndarray, ...]]:
        key = [F.col("toxic").cast("byte").alias("toxic"), F.col("size").cast("byte").alias("size")]
        cells = counts.groupBy(*key, _cell_of(column, GRAM_BITS).cast("int").alias("cell")).agg(*sums).toArrow()
        toxic, size, *rest = (c.to_numpy() for c in cells.columns)
        keys = toxic.astype(np.int16) << 8 | size
        return {(int(k) >> 8, int(k) & 255): tuple(c[keys == k] for c in rest) for k in np.unique(keys)}

    grams, contexts = by("gram", n), by("context", n, F.count(F.lit(1)).cast("float").alias("kinds"))
    return {key: Level(grams[key], part) for key, part in contexts.items()}


def train(docs: DataFrame, labels: DataFrame) -> Models | None:
    """Models from documents (doc_id, text) and labels (doc_id, toxic); None if they show one class or none.

    All ids with remainder 1, 2 and 3 teach the models, at most 6,000 of those with 4 the
    curve; null labels are left out, and of an id labelled twice the higher label holds.
    The shared counts come from all documents.
    """
    small_batches(docs.sparkSession)
    nothing = Level(*((np.zeros(0, np.int32), *[np.zeros(0, np.float32)] * k) for k in (1, 2)))
    teaching = saved(_labels(labels, [1, 2, 3]), "labels")
    found = _levels(_class_counts(_packed_labelled(docs, teaching, [1, 2, 3])))
    if len({c for c, _ in found}) < 2:
        return None
    pairs = docs.select(whole_text().alias("text")).mapInArrow(_pair_counts, "gram long, context long, letter long, n long")
    pairs = saved(pairs.groupBy("gram", "context", "letter").agg(F.sum("n").alias("n")), "pairs")
    shared = _levels(pairs.select(F.lit(BOTH).alias("toxic"), F.lit(SHARED).alias("size"), "gram", "context", "n"))
    letters = pairs.groupBy(_cell_of("letter", LETTER_BITS).alias("cell")).agg(F.sum("n").cast("double").alias("n")).toPandas()
    single = np.zeros(1 << LETTER_BITS)
    single[letters["cell"].to_numpy(np.int64)] = letters["n"].to_numpy()
    levels = {c: {size: found.get((c, size), nothing) for size in range(SHARED + 1, ORDER + 1)} for c in (0, 1)}
    models = Models(single, shared[BOTH, SHARED], levels)
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in batches:
            rows = [f.tolist() for f in reader.features(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "features"])

    some = F.broadcast(_labels(labels, [4]).orderBy(F.xxhash64("label_id"), "label_id").limit(CURVE_DOCS))
    curve = _labelled(docs, some, [4]).mapInArrow(read, "toxic int, features array<double>").toPandas()
    if curve["toxic"].nunique() < 2:
        return None
    models.fit_curve(np.array(curve["features"].tolist()), curve["toxic"].to_numpy(np.float64))
    return models


def scored(docs: DataFrame, models: Models | None) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) added, from the text alone; 0 without models.

    Null and empty texts have no evidence and get the curve's value for none.  A
    column named ``toxicity`` is replaced; others pass through.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("toxicity")
    if models is None:
        return docs.withColumn("toxicity", F.lit(0.0))
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            scores = [shared.value.score(f) for f in reader.features(batch.column(at))]
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "toxicity"])

    return docs.mapInArrow(read, T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())]))
