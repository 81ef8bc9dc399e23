"""Leaks that are lower-cased, partial, short or dense, by both ways of joining, against the SQL."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from smelter.llm import decontaminate

LONG = (
    "A train leaves Boston at 90 km per hour and meets Anna after 3 hours of riding through green fields in the rain while "
    "her brother waits at home with a cup of warm tea and reads the old letters that their mother wrote before the war began"
)
DENSE = "Anna has 5 Apples and Bob 7 Pears so Carl 12 Plums or Dora 3 more"
BENCH = [(1, LONG), (2, "What is the capital of France?"), (3, DENSE), (4, "Too short"), (5, None), (None, "of no id at all, this one is"), (6, "-- -- -- --")]
DOCS = [
    (1, LONG.lower()),
    (2, LONG.upper()),
    (3, "so they say: " + " ".join(LONG.split()[18:40]) + " and no more of it"),
    (4, " ".join(LONG.split()[18:36]) + " and there it ends"),
    (5, "they ask what is the CAPITAL of france, and nobody knows"),
    (6, "what is the capital of spain"),
    (7, DENSE.replace("5", "9").replace("Anna", "Ella")),
    (8, DENSE.replace("Apples", "green apples")),
    (9, LONG.replace("90", "3")),
    (10, None),
    (11, ""),
    (12, "too short -- -- -- -- of no id at all, this one is"),
    (None, LONG.lower()),
]


@pytest.fixture(params=[100_000, 0], ids=["sent", "shuffled"])
def few(request, monkeypatch):
    monkeypatch.setattr(decontaminate, "FEW_WINDOWS", request.param)


def test_leaks_of_every_shape(spark, few):
    docs = spark.createDataFrame([*DOCS, DOCS[0]], "doc_id long, text string")
    bench = spark.createDataFrame([*BENCH, BENCH[0]], "item_id long, text string")
    got = decontaminate.contaminated(docs, bench).drop("row_hash").withColumnRenamed("row_id", "doc_id").toPandas()
    pairs = {(None if r.doc_id != r.doc_id else int(r.doc_id), int(r.item_id)) for r in got.itertuples()}
    assert pairs == {(1, 1), (2, 1), (3, 1), (5, 2), (7, 3), (9, 1), (None, 1)}
    changed = {int(r.doc_id): int(r.changed) for r in got.itertuples() if r.doc_id == r.doc_id}
    assert changed[1] == 0 and changed[7] == 2 and changed[9] == 1

    with duckdb.connect() as db:
        for name, rows, key in (("documents", DOCS, "doc_id"), ("benchmark", BENCH, "item_id")):
            db.execute(f"create table {name} ({key} bigint, text varchar)")
            db.executemany(f"insert into {name} values (?, ?)", rows)
        want = db.sql(decontaminate.LEAKS_SQL).df()
    order = lambda df: sorted(map(str, df[sorted(df.columns)].astype("float").itertuples(index=False)))
    assert order(got) == order(want)


def test_a_leak_in_a_very_long_text(spark, few):
    text = " ".join(f"w{i}x" for i in range(50_000))
    docs = spark.createDataFrame([(1, text + " " + LONG.lower() + " " + text)], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(BENCH, "item_id long, text string")).collect()
    assert [(r.item_id, r.first_pos, r.coverage) for r in found] == [(1, 50_000, 1.0)]


def _leaks(got):
    return sorted(map(str, got.drop("row_hash").withColumnRenamed("row_id", "doc_id").toPandas().astype("float").itertuples(index=False)))


def test_leaks_across_the_ends_of_pieces(spark, few, monkeypatch):
    """Windows, units behind numbers and whole dense items are found wherever a piece of a text ends."""
    walk = "they walk 12 km and then 3 miles or 5 km to get to the old house by the sea"
    shapes = [LONG.lower(), LONG.replace("90", "3"), walk.replace("12", "14"), DENSE.replace("5", "9"), "what is the CAPITAL of france"]
    rows = [(100 * i + n, f"{' '.join(['so'] * n)} {x} and {x} there") for i, x in enumerate(shapes) for n in range(0, 66, 3)]
    docs = spark.createDataFrame([*rows, (None, rows[3][1])], "doc_id long, text string")
    bench = spark.createDataFrame([*BENCH, (7, walk)], "item_id long, text string")
    whole = _leaks(decontaminate.contaminated(docs, bench))
    assert len(whole) == len(rows) + 1
    monkeypatch.setattr(decontaminate, "PIECE", 1)  # 64 tokens, as the longest item that is looked for whole has 16
    assert _leaks(decontaminate.contaminated(docs, bench)) == whole


def test_matches_do_not_carry_the_whole_text(spark, few, monkeypatch):
    """Every matched window came with all tokens of its text, and Spark held those of a text at once."""
    met = []
    meetings = decontaminate._meetings
    monkeypatch.setattr(decontaminate, "_meetings", lambda *a: met.append(meetings(*a)) or met[-1])
    text = " ".join([" ".join(f"w{i}x{k}" for i in range(500)) + " " + LONG for k in range(20)])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(BENCH, "item_id long, text string")).collect()
    assert [(r.item_id, r.first_pos, r.coverage, r.changed) for r in found] == [(1, 500, 1.0, 0)]
    row = met[0].selectExpr("count(*) as n", "max(size(raw)) as tokens").first()
    assert row.n >= 20 * 30 and row.tokens < 1000 < len(text.split())


def test_stage_drops_a_leak_in_a_long_text(spark, monkeypatch, tmp_path):
    """The pipeline's stage keeps the other rows and columns, and holds no text once per match."""
    met = []
    meetings = decontaminate._meetings
    monkeypatch.setattr(decontaminate, "_meetings", lambda *a: met.append(meetings(*a)) or met[-1])
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    filler = " ".join(f"w{i}x" for i in range(6_000))
    rows = [(1, f"{filler} {LONG.replace('90', '70')} {filler}", "a"), (1, filler, "b"), (None, filler, "c"), (None, f"{filler} {LONG}", "d"), (4, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(r.source for r in kept.collect()) == ["b", "c", "e"]
    assert met[0].selectExpr("max(size(raw))").first()[0] < 1000
