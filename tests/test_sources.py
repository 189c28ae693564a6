"""Source files, strict casts, versioned loads and table sinks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from touchtrail.sources import files, raw_files, store
from touchtrail.sources.schemas import RAW_SCHEMAS

CAMPAIGNS = (
    "campaign_name,campaign_id,channel,budget_usd,start_date,end_date,target_company_id\n"
    '"Say ""hi"", all",CMP-001,youtube,15000,2023-03-01,2023-04-30,CTC-001\n'
    "__SOURCE_NULL__,CMP-002,newsletter,5000.505,2023-04-01,2023-06-30,\n"
)
CONTENT = (
    "content_id,channel,publish_date,views,clicks,utm_source,utm_campaign\n"
    "CNT-1,blog,2023-05-02,100,7,,blog_push\n"
)
REVENUE = (
    "revenue_id,company_id,user_id,month,revenue_amount,is_recurring\n"
    "REV-1,CTC-001,USR-1,2023-05,99.5,True\nREV-2,CTC-001,USR-1,2023-06,10,False\n"
)
SIGNUPS = {"signups": [
    {"user_id": "USR-1", "signup_date": "2023-05-01", "company_id": "CTC-001",
     "referral_source": "", "utm_source": "blog", "utm_medium": "email",
     "utm_campaign": "blog_push", "first_touch_channel": "blog", "last_touch_channel": "x"},
]}


@pytest.fixture()
def data_dir(tmp_path):
    (tmp_path / "campaign_metadata.csv").write_text(CAMPAIGNS)
    (tmp_path / "content_performance.csv").write_text(CONTENT)
    (tmp_path / "portfolio_revenue.csv").write_text(REVENUE)
    (tmp_path / "user_signups.json").write_text(json.dumps(SIGNUPS, indent=1))
    return tmp_path


def test_types_blanks_sentinels_and_header_order(spark, data_dir):
    raw = raw_files.read_sources(spark, str(data_dir))
    for table, df in raw.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in RAW_SCHEMAS[table]]
    first, second = raw["campaign_metadata"].orderBy("campaign_id").collect()
    assert first["campaign_name"] == 'Say "hi", all'
    assert second["campaign_name"] is None  # sentinel
    assert second["target_company_id"] == ""  # blank stays blank
    assert str(second["budget_usd"]) == "5000.51"
    assert [r["is_recurring"] for r in raw["portfolio_revenue"].orderBy("revenue_id").collect()] == [
        True, False]
    assert raw["user_signups"].first()["referral_source"] == ""


def test_all_missing_files_are_listed(spark, data_dir):
    (data_dir / "content_performance.csv").unlink()
    (data_dir / "user_signups.json").unlink()
    with pytest.raises(FileNotFoundError) as error:
        raw_files.read_sources(spark, str(data_dir))
    assert "content_performance.csv" in str(error.value)
    assert "user_signups.json" in str(error.value)
    assert "portfolio_revenue.csv" not in str(error.value)


def test_bad_value_aborts(spark, data_dir):
    (data_dir / "portfolio_revenue.csv").write_text(REVENUE.replace("99.5", "lots"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw_files.read_sources(spark, str(data_dir))["portfolio_revenue"].collect()


def test_json_lines_and_folders(spark, tmp_path):
    record = SIGNUPS["signups"][0]
    lines = tmp_path / "lines"
    lines.mkdir()
    for i in range(3):
        (lines / f"part{i}.jsonl").write_text(json.dumps(record | {"user_id": f"U{i}"}) + "\n")
    schema = RAW_SCHEMAS["user_signups"]
    assert raw_files.read_json_source(spark, str(lines), schema, list_field=None).count() == 3
    documents = tmp_path / "documents"
    documents.mkdir()
    for i in range(2):
        (documents / f"{i}.json").write_text(json.dumps(SIGNUPS))
    assert raw_files.read_json_source(spark, str(documents), schema).count() == 2


def test_publish_is_all_or_nothing(spark, data_dir, tmp_path):
    root = str(tmp_path / "raw")
    raw = raw_files.read_sources(spark, str(data_dir))
    counts = store.publish_tables(spark, raw, root)
    assert counts == {"campaign_metadata": 2, "content_performance": 1, "portfolio_revenue": 2,
                      "user_signups": 1}
    before = store.current_version(spark, root)

    broken = dict(raw)
    broken["user_signups"] = raw["user_signups"].withColumn(
        "user_id", F.raise_error(F.lit("broken source")).cast("string"))
    with pytest.raises(Exception, match="broken source"):
        store.publish_tables(spark, broken, root)
    assert store.current_version(spark, root) == before
    assert store.read_published(spark, root, ["portfolio_revenue"])["portfolio_revenue"].count() == 2

    store.publish_tables(spark, raw, root)
    assert store.current_version(spark, root) != before


def test_scratch_uses_the_shared_folder_of_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert store.scratch_dir(spark) == configured
    df = store.materialize(spark.range(5), "numbers")
    assert df.count() == 5
    assert df.inputFiles()[0].replace("file://", "").startswith(configured)


def test_overwrite_and_append_tables(spark):
    df = spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("revenue_date_key"))
    for _ in range(2):
        store.overwrite_table(df, "marts", "sink_check", "revenue_date_key")
    assert store.read_table(spark, "marts", "sink_check").count() == 4
    for _ in range(2):
        store.append_table(df, "marts", "append_check")
    assert store.read_table(spark, "marts", "append_check").count() == 8


def test_scratch_folders_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "_WRITTEN", [])
    path = store.materialize(spark.range(3), "cleared").inputFiles()[0].rsplit("/", 1)[0]
    assert files.exists(spark, path)
    assert store.clear_scratch(spark) == 1 and not files.exists(spark, path)
    assert store.clear_scratch(spark) == 0


def test_a_changed_file_is_a_new_state(spark, tmp_path):
    seen = set()
    for change in (("a", "1"), ("a", "22"), ("b/c", "1")):
        place = tmp_path / "data" / change[0]
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(change[1])
        seen.add(files.stamp(spark, str(tmp_path / "data")))
    assert len(seen) == 3 and files.stamp(spark, str(tmp_path / "data")) in seen


def test_written_sources_are_small_in_files_for_several_tasks(spark, tmp_path, monkeypatch):
    """CSV sources take far fewer bytes than their text, in files that many tasks can read."""
    rows = spark.range(50_000, numPartitions=1).select(
        F.concat(F.lit("REV-"), "id").alias("revenue_id"), F.lit("CTC-001").alias("company_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit('a "quoted", '), F.col("id") % 99)).alias("user_id"),
        F.when(F.col("id") % 3 > 0, "2023-05").otherwise("").alias("month"),
        F.lit("1.50").cast("decimal(18,2)").alias("revenue_amount"), F.lit(True).alias("is_recurring"))
    monkeypatch.setattr(raw_files, "ROWS_PER_FILE", 20_000, raising=False)
    path = str(tmp_path / "portfolio_revenue.csv")
    raw_files.write_csv_source(rows, path)
    parts = list((tmp_path / "portfolio_revenue.csv").glob("part-*"))
    text = sum(len(",".join(map(str, r))) for r in rows.collect())
    assert len(parts) == 3 and sum(p.stat().st_size for p in parts) < text / 3
    read = raw_files.read_csv_source(spark, path, RAW_SCHEMAS["portfolio_revenue"])
    assert read.count() == 50_000 and read.exceptAll(rows).count() == 0
