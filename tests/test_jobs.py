import datetime as dt
import json

import pytest

from smelter.entities import ENTITIES, with_contract_files
from smelter.jobs import main
from tests.samples import TABLES, event_objects, write_tables


def test_steps_one_by_one(spark, tmp_path, capsys):
    lake, paths = str(tmp_path / "lake"), write_tables(tmp_path)
    for name in TABLES:
        main(["ingest", "--lake", lake, "--entity", name, "--source", f"{name}={paths[name]}"])
        main(["clean", "--lake", lake, "--entity", name])
    reports = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [r["record_count"] for r in reports] == [10, 10, 12, 12, 10, 10, 8, 8]
    for table in ("claims_features", "customer_features", "risk_features", "monthly_claims_summary"):
        main(["gold", "--lake", lake, "--table", table])
    assert spark.read.parquet(f"{lake}/gold/risk_features").count() == 10
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "e.json").write_text("\n".join(map(json.dumps, event_objects())))
    main(["realtime", "--lake", lake, "--events", str(tmp_path / "events"), "--lateness", "1 day"])
    assert spark.read.parquet(f"{lake}/silver/claims_realtime").count() == 5
    assert spark.read.parquet(f"{lake}/gold/realtime_claims_features").count() == 0  # long past
    for query in ("alerts", "statuses"):
        main([query, "--lake", lake, "--out", str(tmp_path / query)])
        assert spark.read.text(str(tmp_path / query)).count() == 0

    fresh = {**event_objects()[1], "claim_id": "new", "event_timestamp": dt.datetime.now(dt.timezone.utc).isoformat()}
    (tmp_path / "events" / "f.json").write_text(json.dumps(fresh))
    main(["realtime", "--lake", lake, "--events", str(tmp_path / "events"), "--lateness", "1 day"])
    main(["alerts", "--lake", lake, "--out", str(tmp_path / "alerts")])
    main(["statuses", "--lake", lake, "--out", str(tmp_path / "statuses")])
    assert [json.loads(r.value)["claim_id"] for r in spark.read.text(str(tmp_path / "alerts")).collect()] == ["new"]
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "statuses")).collect()] == [
        {"claim_status": "APPROVED", "count_": 1}]
    assert spark.read.parquet(f"{lake}/gold/realtime_claims_features").count() == 1


def test_arguments_are_checked(spark, tmp_path):
    for argv in (["clean", "--lake", "x"], ["ingest", "--lake", "x", "--entity", "claims"], ["realtime", "--lake", "x"],
                 ["alerts", "--lake", "x"]):
        with pytest.raises(SystemExit):
            main(argv)
    with pytest.raises(ValueError, match="entities"):
        main(["batch", "--lake", str(tmp_path), "--source", "claims=x"])


def test_contract_files(spark, tmp_path):
    (tmp_path / "silver").mkdir()
    doc = {"table_name": "silver_agents", "business_columns": [{"name": "agent_id", "type": "integer", "nullable": False}]}
    (tmp_path / "silver" / "silver_agents.yaml").write_text(json.dumps(doc))
    entity = with_contract_files(spark, ENTITIES["agents"], str(tmp_path))
    assert entity.raw is None and entity.typed.columns[0].type == "integer"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        with_contract_files(spark, ENTITIES["claims"], str(tmp_path))
