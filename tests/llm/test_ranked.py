"""Ranked search against scoring every document for every item."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from smelter.llm import ranked

DOCS = "doc_id long, text string, query string, shard string, rank int, n int, terms string"
ITEMS = "item_id long, text string, score long, terms int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=50):
    counted = [(d, Counter(words_of(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    found = []
    for item, text in set(items):
        scores = []
        for doc, c in counted:
            m = 50 + (50 * sum(c.values()) * total) // length
            score = 0
            for w in set(words_of(text)):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1)))
                    score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            found.append((item, rank, doc, -score))
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, v) for v in r])


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["the", "of", "Über", "日本", "x1", "a_b", "ÀÉ", "😀"] + [f"w{i}" for i in range(60)]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 40), p=weights / weights.sum())) for _ in range(400)]
    docs = list(enumerate(texts)) + [(7, texts[7])] * 130 + [(None, texts[9])] * 3
    docs += [(900, None), (901, ""), (902, " .,;\n"), (903, "The OF THE w5 " * 50_000), (903, "w9")]
    items = [(i, " ".join(rng.choice(vocabulary, 8))) for i in range(12)]
    items += [(20, None), (21, "--"), (22, "unknown"), (23, "THE the w50\x00w51"), (23, "THE the w50\x00w51"), (23, "w3"), (None, "w4 w6")]
    df = spark.createDataFrame([(d, t, "q", "s", 1, 1, "t") for d, t in docs], DOCS).repartition(3)
    return df, spark.createDataFrame([(i, t, 1, 1) for i, t in items], ITEMS), docs, items


@pytest.mark.parametrize("postings, block", [(1 << 21, 4 << 20), (300, 4 << 20), (1 << 21, 100)])
def test_matches_equal_brute_force(odd, monkeypatch, postings, block):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked, "BLOCK_BYTES", block)
    got = [tuple(r) for r in ranked.best_matches(odd[0], odd[1]).collect()]
    assert in_order(got) == in_order(plain(odd[2], odd[3]))


def test_sql_equals_brute_force(odd):
    con = duckdb.connect()
    con.register("documents", odd[0].select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", odd[1].select("item_id", "text").toPandas().astype({"item_id": "Int64"}))
    assert in_order(con.execute(ranked.MATCHES_SQL).fetchall()) == in_order(plain(odd[2], odd[3]))


def test_empty_tables(spark, odd):
    assert ranked.best_matches(odd[0].limit(0), odd[1]).count() == 0
    assert ranked.best_matches(odd[0], odd[1].limit(0)).count() == 0


def test_best_positions_stop_early_and_lose_nothing():
    rng = np.random.default_rng(8)
    documents, vocabulary = 4000, 12
    pairs = np.unique(rng.integers(0, documents, 20_000) * vocabulary + rng.integers(0, vocabulary, 20_000))
    doc, term = pairs // vocabulary, pairs % vocabulary
    impact = (rng.pareto(1.2, len(pairs)) * 5).astype(np.int64) + 1
    lists = ranked.ImpactLists(doc, term, impact, documents, vocabulary)
    for wanted in ([0], [1, 2, 3], list(range(12)), []):
        scores = np.zeros(documents, np.int64)
        np.add.at(scores, doc[np.isin(term, wanted)], impact[np.isin(term, wanted)])
        want = np.lexsort((np.arange(documents), -scores))[:10]
        docs, top, accessed = ranked.best_positions(lists, np.array(wanted, int), 10, np.arange(documents))
        assert docs.tolist() == [d for d in want.tolist() if scores[d] > 0] and top.tolist() == [s for s in scores[want] if s > 0]
        assert accessed < documents / 4
