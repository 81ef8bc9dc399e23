"""What the toxicity operator moves between tasks and holds in one."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import xxhash

from smelter.llm import lines, prefix_free, toxicity

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_packed_texts_are_those_with_a_label(spark):
    texts = ["Plain words", "", None, "кот 猫 " * 300, "words"]
    docs = spark.createDataFrame([(i if i % 11 else None, texts[i % 5]) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(0, 900, 7)] + [(7, None), (14, 1)], "doc_id int, toxic int")
    chosen = toxicity._labels(labels, [1, 2, 3])
    expected = sorted(map(tuple, toxicity._labelled(docs, chosen, [1, 2, 3]).collect()))
    got = toxicity._packed_labelled(docs, chosen, [1, 2, 3])
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 20
    assert got.schema.simpleString() == "struct<toxic:int,text:string>"


def test_texts_without_a_label_are_not_shuffled(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "repeat('word ', 50) as text")
    chosen = toxicity._labels(spark.createDataFrame([(5, 1), (6, 0), (8, 1)], "doc_id long, toxic int"), [0, 1, 2, 3, 4])
    bits = toxicity._label_bits(chosen)
    assert sum(int(b).bit_count() for b in np.unique(bits)) == 3
    assert toxicity._packed_labelled(docs, chosen, [0, 1, 2, 3, 4]).count() == 3


def test_no_label_at_all(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = toxicity._labels(spark.createDataFrame([], "doc_id long, toxic int"), [1, 2, 3])
    assert toxicity._packed_labelled(docs, none, [0, 1, 2, 3, 4]).count() == 0


def test_tables_are_held_once_and_sent_by_cell():
    cells = np.array([3, 70_000], np.int32)
    level = toxicity.Level((cells, np.float32([2, 5])), (cells, np.float32([4, 6]), np.float32([1, 3])))
    sent = pickle.dumps(level)
    again = pickle.loads(sent)
    again.spread()
    held = sum(v.nbytes for v in again.__dict__.values() if isinstance(v, np.ndarray))
    assert held == 3 * 4 << toxicity.GRAM_BITS and again.filled is None
    assert len(sent) < 1_000 and len(pickle.dumps(again)) < 1_000
    level.spread()
    assert all((getattr(again, n) == getattr(level, n)).all() for n in ("counts", "totals", "kinds"))


def test_words_are_scored_in_bounded_numbers():
    asked = []

    class Lengths:
        def evidence(self, words):
            asked.append(len(words))
            return np.array([float(len(w)) for w in words])

        def features(self, evidence, lengths):
            return evidence

    texts = pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 30_000, 5)] + [None])
    found = list(toxicity.Reader(Lengths()).features(texts))
    assert max(asked) <= toxicity.WORDS_AT_ONCE and [len(f) for f in found] == [0, 30_000, 5, 0]
    assert found[1].tolist() == [float(len(f"w{i}")) for i in range(30_000)]


def test_rows_go_to_workers_in_batches_bounded_by_bytes(spark):
    docs = spark.range(40).selectExpr("id as doc_id", "repeat('x', 400000) as text")

    def bytes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    for bound in (lambda: toxicity.scored(docs, None), lambda: prefix_free.repeated_starts(docs.limit(1))):
        spark.conf.unset(BATCH_BYTES)
        bound()
        assert docs.coalesce(1).mapInArrow(bytes_of, "n long").groupBy().max("n").first()[0] < 6 << 20
    spark.conf.unset(BATCH_BYTES)


def _random_level(filled: int, seed: int) -> toxicity.Level:
    rng = np.random.default_rng(seed)
    grams, contexts = (rng.permutation(1 << toxicity.GRAM_BITS)[:n].astype(np.int32) for n in (filled, filled // 3))
    return toxicity.Level(
        (grams, rng.integers(1, 9, len(grams)).astype(np.float32)),
        (contexts, *(rng.integers(1, 9, len(contexts)).astype(np.float32) for _ in range(2))),
    )


def _held(level: toxicity.Level) -> int:
    parts = [*(level.filled or ()), *(level.marks or ()), [v for v in level.__dict__.values() if isinstance(v, np.ndarray)]]
    return sum(a.nbytes for part in parts for a in part)


def test_cells_that_are_not_filled_take_no_room():
    """Asked for probabilities, a level of few grams held three whole tables, 12 MB, in every worker."""
    rng = np.random.default_rng(0)
    gram, context, lower = *rng.integers(0, 1 << toxicity.GRAM_BITS, (2, 5_000)), rng.random(5_000)
    whole = 3 * 4 << toxicity.GRAM_BITS
    for filled, most in ((0, 1 << 19), (1, 1 << 19), (50_000, 1 << 20), (900_000, whole)):
        packed, spread = _random_level(filled, filled), _random_level(filled, filled)
        spread.spread()
        grams, contexts = packed.filled[0][0], packed.filled[1][0]
        some = slice(0, min(len(contexts), 2_000))
        gram[some], context[some] = grams[some], contexts[some]
        assert (packed.probability(gram, context, lower) == spread.probability(gram, context, lower)).all()
        assert _held(packed) <= most and _held(spread) == whole
        assert pickle.dumps(packed) == pickle.dumps(spread)


def test_no_task_runs_two_python_functions(spark):
    """With few labels the join was broadcast, so packing and unpacking met in one task, on a worker each."""
    docs = spark.range(40).selectExpr("id as doc_id", "concat('words of ', id) as text")
    chosen = toxicity._labels(spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic"), [1, 2, 3])
    plan = toxicity._packed_labelled(docs, chosen, [1, 2, 3])._jdf.queryExecution().executedPlan().toString()
    nodes = [x for x in plan.split("Initial Plan")[-1].splitlines() if "MapInArrow" in x or "Exchange" in x]
    functions = [i for i, x in enumerate(nodes) if "MapInArrow" in x]
    assert len(functions) == 2 and any("Exchange" in x for x in nodes[functions[0] : functions[1]])


def test_segments_of_many_lines_leave_in_small_batches():
    """The segments of 20,000 lines were listed at once, as some 300,000 Python numbers twice over."""
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(20, 90, 6_000)]
    listed = [f"{w} {i:012d}" for i, w in enumerate(words)]
    texts = pa.RecordBatch.from_arrays([pa.array(["\n".join(listed[i::7]) for i in range(7)])], ["text"])
    got = list(lines._segment_keys(iter([texts])))
    assert max(b.nbytes for b in got) < 1 << 20
    keys = sorted((r["key"], r["id"]) for b in got for r in b.select(["key", "id"]).to_pylist())
    cells = [(x, c) for x in listed for c in lines._cells(len(x))]
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    expected = [(signed(xxhash.xxh64_intdigest(x[p:q], s)), lines.line_id(x) | role) for x, (s, p, q, role) in cells]
    assert keys == sorted(expected)
    assert lines._cells.cache_info().maxsize <= 1024
