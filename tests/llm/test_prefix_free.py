"""Repeated byte strings against a table of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from smelter.llm import prefix_free
from smelter.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id long, h string, packed int, n_bytes string"


def plain(texts, length=prefix_free.LENGTH):
    data = [(t or "").encode() for t in texts]
    windows = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    results = []
    for d in data:
        marks = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if windows[d[p : p + length]] > 1:
                marks[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(int)))
        removed = [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]
        results.append((len(d), removed, bytes(np.frombuffer(d, np.uint8)[~marks])))
    return results


def made(seed):
    rng = np.random.default_rng(seed)
    letters = list("abcdefghij \nÄ日😀")

    def noise(n):
        return "".join(rng.choice(letters, n))

    passages = [noise(n) for n in (390, 400, 401, 430, 520, 900, 1500)]
    texts = [noise(int(rng.integers(0, 900))) for _ in range(30)]
    for _ in range(60):
        p = passages[rng.integers(len(passages))]
        a = int(rng.integers(0, 40))
        texts.append(noise(int(rng.integers(0, 300))) + p[a : len(p) - int(rng.integers(0, 40))] + noise(int(rng.integers(0, 300))))
    near = list(passages[-1] * 2)
    for _ in range(12):
        near[rng.integers(len(near))] = "X"
        texts.append("".join(near))
    texts += [None, None, "", "x", "q" * 399, "q" * 2000, "ab" * 700, "abc" * 150, noise(700) + "q" * 405]
    texts += [passages[5]] * 3 + [passages[6] + passages[6][:600] + passages[6]]
    once = noise(2500)
    return [*texts, once + noise(200) + once[300:1500]]


@pytest.mark.parametrize("chunk, group, held", [(1 << 20, 4096, 16384), (500, 4096, 5), (1 << 20, 1, 3)])
def test_repeats_equal_brute_force(spark, monkeypatch, chunk, group, held):
    monkeypatch.setattr(prefix_free, "CHUNK", chunk)
    monkeypatch.setattr(prefix_free, "GROUP", group)
    monkeypatch.setattr(prefix_free, "HELD", held)
    texts = made(chunk + group)
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, 1, "h", 2, "n") for i, t in zip(ids, texts)], SCHEMA).repartition(4)
    got = [(r.doc_id, r.n_bytes, [tuple(x) for x in r.removed], bytes(r.kept)) for r in prefix_free.drop_repeated_bytes(docs).collect()]
    want = [(i, *x) for i, x in zip(ids, plain(texts))]
    order = lambda r: (r[0] is None, r[0] or 0, r[3], r[2])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(len(x[2]) for x in want) > 50


def test_suffix_order():
    strings = [b"b", b"ab", b"abc", b"", b"abd", b"b\0", b"b"]
    order, common = prefix_free.suffix_order(np.array([0, 0, 0, 0, 0, 0, 1]), strings)
    assert [strings[i] for i in order] == [b"", b"ab", b"abc", b"abd", b"b", b"b\0", b"b"]
    assert common.tolist() == [-1, 0, 2, 2, 0, 1, -1]


def test_query_on_a_table(spark, tmp_path):
    texts = made(7)
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, 1, "h", 2, "n") for i, t in enumerate(texts)], SCHEMA).write.parquet(path)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_repeated_bytes"](spark, str(tmp_path)).collect()}
    for i, (size, removed, kept) in enumerate(plain(texts)):
        assert got[i] == (size, size - len(kept), len(removed), hashlib.sha256(kept).hexdigest())


def test_no_rows(spark):
    assert prefix_free.drop_repeated_bytes(spark.createDataFrame([], SCHEMA)).count() == 0
