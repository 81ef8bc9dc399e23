"""Repeated runs of sentences against every run of every length."""

import duckdb
import numpy as np
import pytest

from smelter.llm import spans


def plain(texts, least):
    """Texts without the sentences of any run of ``least`` words that begins somewhere before."""
    cut = [[s.strip(spans.BLANK) for s in spans.sentences(t or "")] for t in texts]
    seen, kept = set(), []
    for text, bare in zip(texts, cut):
        gone = set()
        for i in range(len(bare)):
            here = []
            for j in range(i, len(bare)):
                run = tuple(bare[i : j + 1])
                if sum(s.count(" ") + 1 for s in run) >= least:
                    if run in seen:
                        gone.update(range(i, j + 1))
                    here.append(run)
            seen.update(here)
        kept.append("".join(p for k, p in enumerate(spans.sentences(text or "")) if k not in gone) if gone else text)
    return kept


def made(seed):
    rng = np.random.default_rng(seed)
    words = ["one", "two", "three", "four", "é", "日本"]

    def sentence(n):
        return " ".join(rng.choice(words, n)) + str(rng.integers(10**9)) + rng.choice([". ", "! ", ".\n", "? "])

    short = ["".join(sentence(int(rng.integers(1, 4))) for _ in range(30)) for _ in range(4)]
    long = [sentence(60) for _ in range(2)]
    common = [sentence(6) for _ in range(3)]
    texts = []
    for _ in range(60):
        parts = [sentence(int(rng.integers(1, 12))) for _ in range(rng.integers(0, 6))]
        parts += list(rng.choice([*short, *long, *common, *common], rng.integers(0, 3)))
        rng.shuffle(parts)
        texts.append("".join(parts))
    return [*texts, None, "", short[0] + "And on. " + short[0], long[0], "".join(common)]


@pytest.mark.parametrize("least", [1, 10, 25])
def test_removal_equals_every_run(spark, least):
    texts = made(least)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, high string").repartition(3)
    got = {r.doc_id: r.text for r in spans.drop_repeated_runs(docs, least).collect()}
    assert got == dict(enumerate(plain(texts, least)))


def test_sql_equals_every_run():
    texts = made(3)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    got = {r[0]: r[1] for r in con.execute(spans.REPEATS_SQL).fetchall()}
    assert got == dict(enumerate(plain(texts, spans.LEAST_WORDS)))


def test_passages_of_fifty_words_are_found_whole_and_phrases_stay(spark):
    rng = np.random.default_rng(1)
    fresh = iter(range(10**6))

    def text(sizes):
        return "".join(" ".join(f"w{next(fresh)}" for _ in range(n)) + ". " for n in sizes)

    passages = [text([2] * 26), text([51]), text([1, 30, 1, 20]), text([49, 2]), text([7] * 8), text([1] * 52), text([24, 3, 24])]
    phrases = [text([3]), text([12, 11]), text([1] * 20)]
    rows, planted, clean = [], {}, {}
    for i in range(120):
        own = [text(rng.integers(1, 20, 5)) for _ in range(2)]
        p = passages[i % len(passages)]
        if i % 3 == 0:
            rows.append(own[0] + p + own[1])
            planted[i] = (own[0] + own[1], p)
        else:
            rows.append(own[0] + phrases[i % len(phrases)] + own[1])
            clean[i] = rows[-1]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in spans.drop_repeated_runs(docs).collect()}
    first = set()
    for i, (own, p) in planted.items():
        assert got[i] == (own if p in first else rows[i])
        first.add(p)
    assert all(got[i] == t for i, t in clean.items())
