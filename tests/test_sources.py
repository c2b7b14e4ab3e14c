from datetime import date

import pytest
from pyspark.sql import functions as F

from sievewright.contracts import CSV_NA_TOKENS, SALES, SALES_BATCH, SALES_STREAM, all_text
from sievewright.operators import audits
from sievewright.operators.rules import Stamp
from sievewright.plans.batch import run_batch
from sievewright.plans.ingest import run_for_date
from sievewright.sources import files, streams, tables
from sievewright.sources.sinks import Sinks
from sievewright.streaming import runner

from test_operators import STAMP, sales_rows


def test_csv_folder(spark, tmp_path):
    rows = sales_rows(spark, {}, {"Product": " "}, {"Product": "a,b"})
    files.write_csv(rows, f"{tmp_path}/Test_Data_1")
    files.write_csv(rows, f"{tmp_path}/test_data 2")
    files.write_csv(rows, f"{tmp_path}/other")
    got = files.read_csv_folder(spark, str(tmp_path), "test_data", SALES)
    counted = {(r["source_file"], r["n"]) for r in got.groupBy("source_file").agg(F.count("*").alias("n")).collect()}
    assert counted == {("Test_Data_1", 3), ("test_data 2", 3)}
    assert {r["Product"] for r in got.collect()} == {"Bolt", None, "a,b"}


def test_csv_with_another_header_fails(spark, tmp_path):
    files.write_csv(sales_rows(spark, {}).select("Region", "Order_ID"), f"{tmp_path}/test_data")
    with pytest.raises(Exception):
        files.read_csv_folder(spark, str(tmp_path), "test_data", SALES).collect()


def test_empty_folder_has_the_contract(spark, tmp_path):
    got = files.read_csv_folder(spark, str(tmp_path), "test_data", SALES)
    assert got.columns == [*SALES.fieldNames(), "source_file"] and got.count() == 0


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA", "x"), ("Canada", "#N/A")], "a string, b string")
    assert sorted(map(tuple, files.null_tokens_to_null(df, CSV_NA_TOKENS).collect()), key=str) == [
        ("Canada", None), (None, "x")]


def test_raw_landing_replaces_one_day(spark, tmp_path):
    path = f"{tmp_path}/raw"
    files.land_raw(sales_rows(spark, {}, {}), path, "2024-01-01")
    files.land_raw(sales_rows(spark, {}), path, date(2024, 1, 2))
    files.land_raw(sales_rows(spark, {"Product": "Nut"}), path, "2024-01-01")
    assert [r["Product"] for r in files.read_raw(spark, path, date(2024, 1, 1)).collect()] == ["Nut"]
    assert files.read_raw(spark, path, "2024-01-02").count() == 1
    assert files.dated_table("raw_sales", date(2024, 1, 2)) == "raw_sales_2024_01_02"


def test_append_aligned_needs_every_column(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_aligned(sales_rows(spark, {}), path)
    with pytest.raises(Exception):
        tables.append_aligned(sales_rows(spark, {}).drop("Product"), path)


def test_audit_failure_only_reports(spark):
    record = audits.audit_record(spark, "u", "INSERT", "t", "d")
    assert tables.append_audit(record, "nosuchscheme://x/y") is False


def test_quarantine_of_a_day_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/q"
    tables.write_quarantine(spark.createDataFrame([("a", 1), ("b", 2)], "rule string, n int"), path, "2024-01-01")
    tables.write_quarantine(spark.createDataFrame([("b", 3)], "rule string, n int"), path, "2024-01-01")
    assert [(r["rule"], r["n"]) for r in tables.read_quarantine(spark, path).collect()] == [("b", "3")]


def test_jdbc_options():
    db = tables.JdbcTarget("jdbc:x://host/db", {"user": "u"})
    assert db.read_options("t", key="id", lower=0, upper=9, partitions=4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        db.read_options("t", key="id")
    assert db.write_options("t", SALES)["createTableColumnTypes"].startswith("`Order_ID` INTEGER, `Customer_Name` TEXT")


def test_kafka_options_and_envelope(spark):
    assert streams.kafka_read_options("h:9092", "sales", max_offsets=100)["maxOffsetsPerTrigger"] == "100"
    assert streams.kafka_write_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}
    df = spark.createDataFrame([("h", 1, ["a"])], "row_hash string, n int, l array<string>")
    assert tuple(streams.to_envelope(df, "row_hash").first()) == ("h", '{"row_hash":"h","n":"1","l":"[\\"a\\"]"}')
    assert streams.to_envelope(df).first()["key"] is None


def test_decode_keeps_what_is_not_json(spark):
    df = spark.createDataFrame([('{"Order_ID": 5, "Region": "West"}',), ("{oops",)], "value string")
    good, bad = streams.split_corrupt(streams.decode(df, all_text(SALES)))
    assert good.first()["Order_ID"] == "5" and [r["payload"] for r in bad.collect()] == ["{oops"]


def json_file(rows, path, extra=()):
    lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    for line in extra:
        lines = lines.unionByName(rows.sparkSession.createDataFrame([(line,)], "value string"))
    lines.coalesce(1).write.mode("append").text(path)


def stream_of(spark, path, max_files=None):
    return streams.decode(streams.json_lines_stream(spark, path, max_files), all_text(SALES))


def run_pipeline(spark, tmp_path, name, max_files=None):
    job = runner.Job(name, f"{tmp_path}/cp-{name}")
    runner.start_pipeline(stream_of(spark, f"{tmp_path}/in", max_files), Sinks(str(tmp_path)), SALES_STREAM, STAMP,
                          job).awaitTermination()
    return sorted(r["Order_ID"] for r in spark.read.parquet(f"{tmp_path}/target").collect())


def test_stream_split_replay_and_corrupt_payload(spark, tmp_path):
    path = f"{tmp_path}/in"
    json_file(sales_rows(spark, {}, {"Order_ID": "2"}, {"Order_ID": "2"}), path, extra=["{oops"])
    json_file(sales_rows(spark, {"Order_ID": "2"}, {"Order_ID": "3"}, {"Order_ID": "4", "Region": "Nrth"}), path)
    assert run_pipeline(spark, tmp_path, "split", max_files=1) == [1, 2, 3]
    assert run_pipeline(spark, tmp_path, "replay") == [1, 2, 3]
    found = tables.read_quarantine(spark, f"{tmp_path}/quarantine")
    assert {r["rule"] for r in found.select("rule").collect()} == {"corrupt_json", "invalid_region"}
    assert found.where("rule = 'corrupt_json'").first()["bad_value"] == "{oops"
    assert {r["action"] for r in spark.read.parquet(f"{tmp_path}/audit").collect()} == {"INSERT"}


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    path = f"{tmp_path}/in"
    for order in ("1", "2"):
        json_file(sales_rows(spark, {"Order_ID": order}), path)
        job = runner.Job("raw", f"{tmp_path}/cp")
        runner.start_raw_sink(stream_of(spark, path), f"{tmp_path}/t", f"{tmp_path}/bad", job).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/t")
    assert sorted((r["Order_ID"], r["run"].rsplit("-", 1)[1]) for r in got.collect()) == [("1", "0"), ("2", "1")]


def test_detectors_fan_out(spark, tmp_path):
    path = f"{tmp_path}/in"
    json_file(sales_rows(spark, {"Order_ID": "x1", "Product": "a   b"}, {"Region": "Wst", "Quantity": "0"}), path, ["{"])
    job = runner.Job("det", f"{tmp_path}/cp")
    stamp = Stamp(STAMP.run_ts, "stream")
    runner.start_detectors(stream_of(spark, path), f"{tmp_path}/q", SALES_STREAM, stamp, job).awaitTermination()
    found = {r["rule"] for r in tables.read_quarantine(spark, f"{tmp_path}/q").collect()}
    assert found == {"negative_values", "region_conflicts", "bigint_values", "typos", "id_changes", "string_changes",
                     "corrupt_json"}


def test_unknown_columns_are_refused(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_aligned(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    with pytest.raises(ValueError, match="no column c"):
        tables.append_aligned(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), path)


def test_jobs_and_batch_share_one_root(spark, tmp_path):
    """Two streams with checkpoints of their own, and a batch job: nobody replaces what another has written."""
    sinks = Sinks(f"{tmp_path}/out")
    for k in (1, 2):
        folder = tmp_path / f"in{k}"
        folder.mkdir()
        (folder / "a.json").write_text(f'{{"Order_ID": "{k}", "Region": "Nowhere"}}\n')
        stream = streams.decode(streams.json_lines_stream(spark, str(folder)), all_text(SALES))
        runner.start_raw_sink(stream, f"{tmp_path}/raw", f"{tmp_path}/bad", runner.Job("raw", f"{tmp_path}/raw{k}")).awaitTermination()
        runner.start_pipeline(stream, sinks, SALES_STREAM, STAMP, runner.Job("load", f"{tmp_path}/load{k}")).awaitTermination()
    row = spark.createDataFrame([("3", None, "Nowhere", *[None] * 6)], all_text(SALES))
    run_batch(spark, SALES_BATCH, row, sinks, "2024-01-31", STAMP)
    assert sorted(r["Order_ID"] for r in spark.read.parquet(f"{tmp_path}/raw").collect()) == ["1", "2"]
    found = tables.read_quarantine(spark, sinks.path("quarantine")).where("rule = 'invalid_region'").collect()
    assert sorted(r["Order_ID"] for r in found) == ["1", "2", "3"] and len({r["run"] for r in found}) == 3
    audit = spark.read.parquet(sinks.path("audit"))
    assert audit.columns == list(tables.AUDIT_COLUMNS) and audit.count() == 3


def test_ingest_unites_column_orders_and_repeats_from_raw(spark, tmp_path):
    inbox, raw, day = f"{tmp_path}/in", f"{tmp_path}/raw", "2024-01-31"
    names = SALES.fieldNames()
    with pytest.raises(ValueError):
        run_for_date(spark, SALES_BATCH, inbox, "test_data", raw, Sinks(f"{tmp_path}/none"), day, STAMP)
    for i, order in enumerate((names, names[::-1], names[3:] + names[:3])):
        rows = sales_rows(spark, {"Order_ID": str(2 * i + 1)}, {"Order_ID": str(2 * i + 2), "Product": "a,b"})
        files.write_csv(rows.select(*order), f"{inbox}/Test_Data {i}")
    assert len(files.csv_headers(spark, inbox, "test_data")) == 3
    ids = []
    for name, again in (("first", False), ("again", True)):
        sinks = Sinks(f"{tmp_path}/{name}")
        counts = run_for_date(spark, SALES_BATCH, inbox, "test_data", raw, sinks, day, STAMP, force_from_raw=again)
        assert counts["raw"] == 6
        ids.append(sorted(r["Order_ID"] for r in spark.read.parquet(sinks.name).collect()))
    assert ids[0] == ids[1] and ids[0]
