"""Committed tables, lookups by key, replay into a database, malformed CSV lines."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sievewright.catalog.queries import _FailsAtLoad
from sievewright.contracts import SALES, SALES_BATCH, SALES_STREAM, all_text
from sievewright.operators.keyed import drop_listed
from sievewright.plans.batch import run_batch
from sievewright.plans.ingest import run_for_date
from sievewright.sources import commits, files
from sievewright.sources.commits import Store
from sievewright.sources.sinks import CommittedSinks, JdbcSinks, Sinks
from sievewright.sources.tables import JdbcTarget, read_quarantine
from sievewright.streaming import runner

from test_operators import STAMP, sales_rows
from test_sources import json_file, stream_of


def put(store, run, ids, files=None, **options):
    commit = store.commit(run)
    df = store.spark.createDataFrame([(i, f"v{i}") for i in ids], "id bigint, v string")
    commit.add("t", df, "id", files=files, **options)
    return commit


def ids_of(df):
    return sorted(r[0] for r in df.collect())


def test_nothing_is_visible_before_the_record(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    assert store.read("t") is None and store.keys("t", "id") is None and not store.has_run("a")
    commit = put(store, "a", [1, 2])
    commit.add("q", spark.createDataFrame([("x",)], "why string"))
    assert store.read("t") is None and store.read("q") is None
    commit.publish()
    assert ids_of(store.read("t").select("id")) == [1, 2] and store.read("q").count() == 1 and store.has_run("a")
    put(store, "b", [])  # staged only
    put(store, "c", []).publish()
    assert ids_of(store.read("t").select("id")) == [1, 2]
    with pytest.raises(ValueError, match="integer"):
        store.commit("d").add("t", spark.createDataFrame([("x",)], "id string"), "id")


def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    for run, ids in (("mon", [1, 2]), ("tue", [3]), ("mon", [4]), ("tue", [])):
        put(store, run, ids, replaces=True).publish()
    assert ids_of(store.read("t").select("id")) == [4]


def test_a_lookup_reads_the_files_that_can_match(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    put(store, "a", range(0, 4000, 2), files=8).publish()
    put(store, "b", range(100_000, 104_000, 2), files=8).publish()
    put(store, "c", [-(1 << 63), (1 << 63) - 1]).publish()
    lookup, every = store.keys("t", "id"), store.files("t")
    assert len(every) >= 17

    def asked(values):
        return spark.createDataFrame([(v,) for v in values], "k bigint")

    def expected(values):
        ranges = [(r["file"], r["lo"], r["hi"]) for r in store.live("t").collect()]
        return sorted(f for f, lo, hi in ranges if any(v is not None and lo <= v <= hi for v in values))

    for values in ([], [None], [7], [10, 11], [3999, 50_000], [100_000, 103_998, None], [-5], [(1 << 63) - 1], list(range(0, 5000))):
        # Cells are coarser than ids, so a file between two ids of one cell may be read in vain, but none is left out.
        got = lookup.files_for(asked(values))
        assert set(expected(values)) <= set(got)
        assert ids_of(lookup.matching(asked(values))) == sorted(
            v for v in values if v is not None and (v in (-(1 << 63), (1 << 63) - 1) or v % 2 == 0 and (0 <= v < 4000 or 100_000 <= v < 104_000)))
    # One id: a file of its load, and the file that spans all ids.
    assert len(lookup.files_for(asked([10]))) <= 2 and len(lookup.files_for(asked([60_000]))) <= 1
    store.compact("t", "id", rows_per_file=500)
    assert len(lookup.files_for(asked([10]))) <= 2 < len(store.files("t"))


def test_a_lookup_by_some_keys_asks_the_reader_for_them(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    put(store, "a", range(0, 1000, 2)).publish()
    few = store.keys("t", "id").matching(spark.createDataFrame([(4,), (5,)], "k bigint"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(id," in plan
    chunk = pq.ParquetFile(store.files("t")[0].removeprefix("file:").replace("///", "/")).metadata.row_group(0).column(0)
    with open(store.files("t")[0].removeprefix("file:").replace("///", "/"), "rb") as raw:
        # Bloom filters stand between the columns and the footer.
        assert os.fstat(raw.fileno()).st_size > chunk.total_compressed_size + 200


def test_many_small_loads_are_compacted(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    for k in range(6):
        put(store, f"run{k}", range(k, 600, 6)).publish()
    before, old = ids_of(store.read("t").select("id")), store.read("t")
    assert len(store.files("t")) >= 6
    store.compact("t", "id", rows_per_file=200)
    assert ids_of(store.read("t").select("id")) == before == list(range(600))
    live = sorted((r["lo"], r["hi"]) for r in store.live("t").collect())
    assert len(live) <= 4 and all(a[1] < b[0] for a, b in zip(live, live[1:]))
    assert ids_of(old.select("id")) == before  # a reader from before still finds its files
    store.compact("t", "id", rows_per_file=200)
    assert sorted((r["lo"], r["hi"]) for r in store.live("t").collect()) == live
    assert len(store.keys("t", "id").files_for(spark.createDataFrame([(5,)], "k bigint"))) == 1


def test_a_summary_says_what_all_records_say(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    store.summarise()
    for run, ids in (("mon", [1, 2]), ("tue", [3]), ("mon", [4]), ("wed", [])):
        put(store, run, ids, replaces=True).publish()
    for k in range(3):
        commit = store.commit(f"load{k}")
        commit.add("keyed", spark.createDataFrame([(i,) for i in range(k, 30, 3)], "id bigint"), "id")
        commit.publish()
    late = put(store, "late", [9])
    store.compact("keyed", "id")

    def state():
        return (ids_of(store.read("t").select("id")), ids_of(store.read("keyed")), store.last(), [store.has_run(r) for r in ("mon", "wed", "load0", "no")])

    before = state()
    assert before[:2] == ([3, 4], list(range(30))) and before[3] == [True, True, True, False]
    store.summarise()
    assert len(store._listed()[0]) == 1 and state() == before
    late.publish()  # begun before the summary, published after it
    assert ids_of(store.read("t").select("id")) == [3, 4, 9] and len(store._listed()[0]) == 2
    store.summarise()
    store.summarise()
    assert len(store._listed()[0]) == 1 and ids_of(store.read("t").select("id")) == [3, 4, 9] and ids_of(store.read("keyed")) == list(range(30))
    put(store, "mon", [], replaces=True).publish()
    assert ids_of(store.read("t").select("id")) == [3, 9]


def test_a_stream_that_fails_between_quarantine_and_load(spark, tmp_path):
    path, sinks = f"{tmp_path}/in", CommittedSinks(f"{tmp_path}/out")
    json_file(sales_rows(spark, {}, {"Order_ID": "2"}, {"Order_ID": "3", "Region": "Nrth"}), path, extra=["{oops"])

    def deliver(into, name="job"):
        runner.start_pipeline(stream_of(spark, path), into, SALES_STREAM, STAMP, runner.Job(name, f"{tmp_path}/cp-{name}")).awaitTermination()

    with pytest.raises(StreamingQueryException, match="stopped before the load"):
        deliver(_FailsAtLoad(sinks.root))
    store = sinks.store(spark)
    assert store.read("target") is None and store.read("quarantine") is None
    deliver(sinks)
    assert ids_of(store.read("target").select("Order_ID")) == [1, 2]
    rules = sorted(r["rule"] for r in store.read("quarantine").collect())
    assert rules == ["corrupt_json", "invalid_region"]
    deliver(sinks)
    deliver(sinks, "another")  # a job of its own: keys that are there are not loaded again
    assert ids_of(store.read("target").select("Order_ID")) == [1, 2] and store.last() == 2
    assert [r["action"] for r in spark.read.parquet(f"{sinks.root}/audit").orderBy("logged_at", "action").collect()].count("ROLLBACK") == 1


def test_a_batch_of_a_day_again(spark, tmp_path):
    sinks = CommittedSinks(f"{tmp_path}/out")
    for rows, loaded in ((sales_rows(spark, {}, {"Order_ID": "2", "Region": "Nrth"}), 1), (sales_rows(spark, {}, {"Order_ID": "3"}), 1)):
        counts = run_batch(spark, SALES_BATCH, rows, sinks, "2024-01-31", STAMP)
        assert counts["loaded"] == loaded
    store = sinks.store(spark)
    assert ids_of(store.read("target").select("Order_ID")) == [1, 3] and store.read("quarantine").count() == 0
    assert {r["stage"]: r["rows"] for r in store.read("report").collect()} == {"raw": 2, "loaded": 1}


def test_clean_rows_are_written_once(spark, tmp_path, monkeypatch):
    """No held copy of the clean rows: the load is the write that counts them."""
    from sievewright.storage import Workspace

    held, hold = [], Workspace.hold
    monkeypatch.setattr(Workspace, "hold", lambda self, df, name: held.append(name) or hold(self, df, name))
    counts = run_batch(spark, SALES_BATCH, sales_rows(spark, {}, {"Order_ID": "2"}), Sinks(f"{tmp_path}/out"), "2024-01-31", STAMP)
    assert counts == {"raw": 2, "loaded": 2} and "clean" not in held


def test_a_database_gets_each_record_of_a_batch_once(spark, monkeypatch):
    """No database here: a dictionary of frames stands for it, and the third table breaks off in the middle the first time."""
    tables, trouble = {}, ["dirty_null_values_2024_01_01"]

    def write(self, df, table, mode="append", text=False):
        rows = [tuple(r) for r in df.collect()]
        if table in trouble:
            trouble.remove(table)
            tables[table] = spark.createDataFrame(rows[:1], df.schema)
            raise RuntimeError("connection lost")
        new = spark.createDataFrame(rows, df.schema)
        tables[table] = tables[table].unionByName(new) if table in tables and mode == "append" else new

    def read(self, spark, table, **split):
        if table not in tables:
            raise RuntimeError("no such table")
        return tables[table]

    monkeypatch.setattr(JdbcTarget, "write", write)
    monkeypatch.setattr(JdbcTarget, "read", read)
    names = ["rule", "issue", "flagged", "bad_value", "source_file", "project_name", "logged_at", "row_hash", "suggested_value", *SALES.fieldNames()]
    base = [("null_values", "i", "f", None, "s", "p", f"h{k % 2}") for k in range(5)] + [("invalid_region", "i", "f", None, "s", "p", "h")] * 3

    def records(when):
        return spark.createDataFrame([(*r[:6], when, r[6], None, *["x"] * 9) for r in base], ", ".join(f"`{n}` string" for n in names))

    sinks = JdbcSinks(JdbcTarget("jdbc:x:y"), "sales", SALES.fieldNames())
    with pytest.raises(RuntimeError, match="connection lost"):
        sinks.quarantine(records("10:00"), "job-0", "2024-01-01")
    for _ in range(2):
        sinks.quarantine(records("10:05"), "job-0", "2024-01-01")
    sinks.quarantine(records("10:10"), "job-1", "2024-01-01")
    for table, n in (("dirty_null_values_2024_01_01", 5), ("dirty_invalid_region_2024_01_01", 3)):
        runs = {r["run"]: r["n"] for r in tables[table].groupBy("run").agg(F.count("*").alias("n")).collect()}
        assert runs == {"job-0": n, "job-1": n}
    assert sorted(r["row_hash"] for r in tables["dirty_null_values_2024_01_01"].where("run = 'job-0'").collect()) == ["h0"] * 3 + ["h1"] * 2


def test_events_go_to_their_topics(spark, monkeypatch):
    """No broker here: the envelopes are recorded."""
    sent = []
    monkeypatch.setattr(JdbcSinks, "send", lambda self, envelopes: sent.extend(tuple(r) for r in envelopes.collect()))
    monkeypatch.setattr(JdbcTarget, "write", lambda self, df, *args, **options: df.count())
    monkeypatch.setattr(JdbcTarget, "read", lambda self, spark, table, **split: spark.createDataFrame([], "Order_ID int"))
    sinks = JdbcSinks(JdbcTarget("jdbc:x:y"), "sales", SALES.fieldNames(), kafka_servers="h:9092")
    rows = sales_rows(spark, {}, {"Order_ID": "2", "Quantity": "two", "Product": "12"}, {"Order_ID": "3", "Region": "Nrth"})
    run_batch(spark, SALES_BATCH, rows, sinks, "2024-01-31", STAMP)
    topics = sorted(t for t, _, _ in sent)
    assert topics == ["audit-events", "dirty-region-events", "dirty-type-events", "dirty-type-schema"]
    values = {t: v for t, _, v in sent}
    assert '"columns":["Product","Quantity"]' in values["dirty-type-schema"] and '"details":"Loaded 1 rows"' in values["audit-events"]
    sent.clear()
    run_batch(spark, SALES_BATCH, sales_rows(spark, {"Order_ID": "5"}), sinks, "2024-01-31", STAMP)
    assert [t for t, _, _ in sent] == ["audit-events"]


ABC = StructType([StructField(c, StringType()) for c in "abc"])


def text_file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())


def read_abc(spark, folder, **options):
    rows = files.read_csv_folder(spark, str(folder), "f", ABC, **options).collect()
    return sorted((tuple(r[c] for c in ("a", "b", "c", "malformed_csv")) for r in rows), key=repr)


def test_lines_that_are_no_records(spark, tmp_path):
    text_file(tmp_path / "in", "f1.csv", '﻿a,b,c\n1,2,3\n3,4,5,6\n7,8\n"x,1",y,"z"\n\n  \n9,"broken,1\n9,bro"ken,1\n,,\n"q\\"r",s,t\n')
    text_file(tmp_path / "in", "f2.csv", '"a","b","c"\r\n4,5,6\r\n')
    text_file(tmp_path / "in", "f3.csv", "a,b,c\n")
    good = [("1", "2", "3", None), ("4", "5", "6", None), ("x,1", "y", "z", None), (None, None, None, None), ('q"r', "s", "t", None)]
    bad = ["3,4,5,6", "7,8", '9,"broken,1', '9,bro"ken,1']
    assert read_abc(spark, tmp_path / "in", malformed="column") == sorted([*good, *((None, None, None, b) for b in bad)], key=repr)
    with pytest.raises(Exception, match="malformed line in f1.csv"):
        files.read_csv_folder(spark, str(tmp_path / "in"), "f", ABC).collect()
    with pytest.raises(Exception, match="malformed line in f1.csv"):
        files.read_csv_folder(spark, str(tmp_path / "in"), "f", ABC).select("c").count()
    with pytest.raises(ValueError):
        files.read_csv_folder(spark, str(tmp_path / "in"), "f", ABC, malformed="drop")


def test_values_with_line_breaks(spark, tmp_path):
    text_file(tmp_path / "in", "f.csv", 'a,b,c\n1,"two\nlines",3\n4,5,6\n7,8\n')
    assert read_abc(spark, tmp_path / "in", malformed="column", multi_line=True) == sorted(
        [("1", "two\nlines", "3", None), ("4", "5", "6", None), (None, None, None, "7,8")], key=repr)
    # Line by line both halves are reported, and nothing is lost or taken for a record.
    assert read_abc(spark, tmp_path / "in", malformed="column") == sorted(
        [("4", "5", "6", None), (None, None, None, '1,"two'), (None, None, None, 'lines",3'), (None, None, None, "7,8")], key=repr)


@pytest.mark.parametrize("make", [Sinks, CommittedSinks])
def test_malformed_lines_reach_the_quarantine_and_stay_landed(spark, tmp_path, make):
    names = SALES.fieldNames()
    good = ["1", "Ann", "West", "2024-01-05", "Bolt", "2", "5", "10", "Cash"]
    lines = [",".join(names), ",".join(good), ",".join(["2", *good[1:], "more"]), "3,Ann", '4,"Ann' + ",x" * 8]
    text_file(tmp_path / "in", "Test_Data 1.csv", "\n".join(lines) + "\n")
    text_file(tmp_path / "in", "Test_Data 2.csv", ",".join(names[::-1]) + "\n" + ",".join(["5", *good[1:]][::-1]) + "\n1,2\n")
    for again in (False, True):
        sinks = make(f"{tmp_path}/out{again}")
        counts = run_for_date(spark, SALES_BATCH, str(tmp_path / "in"), "test_data", f"{tmp_path}/raw", sinks, "2024-01-31", STAMP, force_from_raw=again)
        assert counts == {"raw": 6, "loaded": 2, "malformed_csv": 4}
        found = sinks.store(spark).read("quarantine") if make is CommittedSinks else read_quarantine(spark, sinks.path("quarantine"))
        assert sorted((r["rule"], r["bad_value"], r["source_file"]) for r in found.collect()) == sorted(
            ("malformed_csv", line, f"Test_Data {k}.csv") for k, line in ((1, lines[2]), (1, lines[3]), (1, lines[4]), (2, "1,2")))
        target = sinks.store(spark).read("target") if make is CommittedSinks else spark.read.parquet(sinks.name)
        assert ids_of(target.select("Order_ID")) == [1, 5]


def test_lookups_serve_the_financials_too(spark, tmp_path):
    from test_pipelines import financial_row
    from sievewright.contracts import FINANCIALS, FINANCIALS_BATCH

    sinks = CommittedSinks(f"{tmp_path}/out")
    for first, n in ((0, 5), (3, 3)):
        rows = spark.createDataFrame([financial_row(**{"Row ID": str(i)}) for i in range(first, first + 5)], all_text(FINANCIALS))
        assert run_batch(spark, FINANCIALS_BATCH, rows, sinks, f"2024-01-{10 + first}", STAMP)["loaded"] == n
    assert ids_of(sinks.store(spark).read("target").select(F.col("`Row ID`"))) == list(range(8))
    assert commits.FEW_KEYS and drop_listed
