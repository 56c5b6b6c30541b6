import json

from shoreline.__main__ import main
from shoreline.session import listed_bytes, size_session, sizing

DAY = "2026-04-17"


def test_jobs_by_name(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    topic = tmp_path / "in" / "topic=events.user"
    topic.mkdir(parents=True)
    lines = [json.dumps({"event_id": f"e{i}", "user_id": "u", "timestamp": f"{DAY}T10:00:00Z"})
             for i in range(3)]
    (topic / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "crm.json").write_text(json.dumps([{"customer_id": "c1", "email": "a"}]))
    monkeypatch.setenv("PROCESSING_DATE", DAY)
    assert main(["ingest", "--lake", lake, "--files", str(tmp_path / "in"),
                 "--checkpoint", str(tmp_path / "cp"), "--available-now"]) == 0
    assert main(["land", "--lake", lake, "--source", "crm",
                 "--drop", str(tmp_path / "crm.json")]) == 0
    assert main(["silver", "--lake", lake, "--allow-missing"]) == 0
    assert main(["silver", "--lake", lake, "--domain", "customers"]) == 0
    assert main(["gold", "--lake", lake, "--allow-missing"]) == 0
    assert main(["gold", "--lake", lake, "--kpi", "user_retention"]) == 0
    assert main(["day", "--lake", lake, "--date", DAY, "--allow-missing"]) == 0
    assert main(["validate", "--lake", lake]) == 0
    # three KPIs have no rows, but all tables are there
    assert main(["verify", "--lake", lake]) == 0
    assert main(["verify", "--lake", str(tmp_path / "other")]) == 1


def test_sizing_follows_the_input():
    tera = 1024 ** 4
    small, large, huge = (sizing(n) for n in (1024 ** 3, 10 * tera, 100 * tera))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(small[key]) == 200
    assert int(large[key]) == 10 * tera // (512 * 1024 ** 2)
    assert int(huge[key]) == 100 * tera // (512 * 1024 ** 2)
    assert "spark.sql.files.maxPartitionBytes" not in huge


def test_the_session_is_sized_by_the_listed_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.json").write_text("1" * 100)
    (tmp_path / "a" / "b" / "y.json").write_text("1" * 50)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert listed_bytes(spark, str(tmp_path / "a"), str(tmp_path / "none")) == 150
        assert size_session(spark, str(tmp_path / "a")) == 150
        assert spark.conf.get(key) == "200"
    finally:
        for name in sizing(0):
            spark.conf.unset(name)
