"""The forest in a session that observes metrics, as the other flows do."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from smelter.llm import secret_scan


def test_scan_after_an_observation(spark):
    seen = Observation("before")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 3}
    rows = [(i, f"password = {i:016x}abcdef and mail a{i}@example.org") for i in range(60)]
    rows += [(100 + i, f"see src/part{i}/module/file or number 1234567890123{i:04d}") for i in range(60)]
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    scores = {(r.doc_id, r.value): r.score for r in found.collect()}
    assert all(s > 0.5 for (d, v), s in scores.items() if d < 100 and "@" not in v) and len(scores) > 100
