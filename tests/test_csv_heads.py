"""Headers are found from the heads of files."""

import gzip

from smelter.sources import read_raw_csv


def test_mixed_headers(spark, tmp_path):
    folder = tmp_path / "with space & 100%"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (folder / "b.csv").write_text("\n  \nname,id,extra\nz,3,é\n")
    (folder / "empty.csv").write_text("")
    (folder / "c.csv").write_text("id,name\n")
    with gzip.open(folder / "d.csv.gz", "wt") as out:
        out.write("id,name\n" + "".join(f"{i},n{i}\n" for i in range(4, 2000)))
    got = {tuple(r) for r in read_raw_csv(spark, str(folder)).select("id", "name", "extra").collect()}
    want = {("1", "x", None), ("2", "y", None), ("3", "z", "é")} | {(str(i), f"n{i}", None) for i in range(4, 2000)}
    assert got == want


def test_heads_take_no_job_and_no_scan(spark, tmp_path):
    for name, header in (("a.csv", "id,name"), ("b.csv", "name,id")):
        (tmp_path / name).write_text(header + "\n" + "1,2\n" * 100_000)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("heads", "heads")
    df = read_raw_csv(spark, str(tmp_path))
    jobs = tracker.getJobIdsForGroup("heads")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Only the column names of each group are read by a job, from the first row.
    tasks = [t for j in jobs for s in tracker.getJobInfo(j).stageIds if (i := tracker.getStageInfo(s)) for t in [i.numTasks]]
    assert len(jobs) <= 2 and sum(tasks) <= 2
    assert df.count() == 200_000


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\n")
    assert read_raw_csv(spark, str(tmp_path)).count() == 0
