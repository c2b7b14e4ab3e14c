import hashlib
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sievewright.contracts import FINANCIALS, FINANCIALS_BATCH, SALES, SALES_BATCH, SALES_STREAM, all_text
from sievewright.fixtures import sales_raw, table
from sievewright.operators.rules import Stamp
from sievewright.plans import financials, sales
from sievewright.plans.batch import run_batch
from sievewright.sources.sinks import RULES, JdbcSinks, Sinks, rule_table, to_topics
from sievewright.sources.tables import JdbcTarget
from sievewright.storage import Workspace, is_small

STAMP = Stamp(datetime(2024, 1, 1), "file.csv")
NAMES = SALES.fieldNames()

# Planted-dirt counts of the sales view, with ids divisible by ten already loaded.
EXPECTED = {
    "sf0.001": {"raw": 1473, "invalid_region": 32, "region_conflicts": 146, "type_conversion": 95, "null_values": 73,
                "negative_values": 29, "unknown_chars": 64, "loaded": 914},
    "sf0.01": {"raw": 14743, "invalid_region": 306, "region_conflicts": 1485, "type_conversion": 909, "null_values": 695,
               "negative_values": 269, "unknown_chars": 608, "loaded": 9206},
}


@pytest.mark.parametrize("size", EXPECTED)
def test_stage_counts(spark, size):
    sf_dir = f"/root/testdata/{size}"
    keys = table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0").selectExpr("cast(o_orderkey AS int) AS Order_ID")
    result = sales.run(sales_raw(spark, sf_dir), SALES_BATCH, STAMP, Workspace(spark, "t"), keys)
    assert {r["stage"]: r["rows"] for r in result.report.collect()} == EXPECTED[size]


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        customer = rng.choice([f"customer {rng.randint(1, 30)}"] * 6 + ["José 1", None, "A & B 2"] + ["Customer 77"] * 2)
        home = "West" if len(customer or "") % 2 else "East"
        rows.append((
            rng.choice([str(rng.randint(1, 60))] * 6 + ["0" + str(rng.randint(1, 9)), "x1", None, "+7"]),
            customer,
            rng.choice([home] * 60 + [home.lower(), "North", "Nrth", None]),
            rng.choice(["2024-01-05", "05-01-2024", "2024-02-30", "March"] + ["2024-03-01"] * 16),
            rng.choice(["12345", "NA", "Nut x"] + ["Bolt"] * 12),
            rng.choice(["1", "2", "0", "-3", "two"] + ["4"] * 20),
            rng.choice(["5", "$1,200"] + ["6"] * 20), "10", rng.choice(["Cash", "Card"]),
        ))
    return rows


def title(value):
    if value is None or value.strip(" ").lower() in ("", "null", "none", "nan"):
        return None
    return " ".join(w[:1].upper() + w[1:] for w in re.sub(r"\s+", " ", value.strip(" ")).lower().split(" "))


def read_date(value):
    for f in ("%Y-%m-%d", "%d-%m-%Y", "%m-%d-%Y"):
        try:
            return datetime.strptime(value, f).date()
        except ValueError:
            continue
    return None


def number(value):
    return int(value) if re.fullmatch(r"[+-]?\d+", value or "") else None


def brute_force(rows, loaded, reject_by):
    """The rules one after the other, on Python lists."""
    rows = [tuple(title(v) for v in r) for r in rows]
    rows = [r for r in rows if r[2] is None or r[2] in SALES_BATCH.regions]
    regions = {}
    for r in rows:
        if r[1] is not None and r[2] is not None:
            regions.setdefault(r[1], set()).add(r[2])
    rows = [r for r in rows if len(regions.get(r[1], ())) < 2]

    def type_dirty(r):
        ints = any(r[i] is not None and not re.fullmatch(r"-?\d+", r[i]) for i in (0, 5, 6, 7))
        texts = any(r[i] is not None and re.fullmatch(r"\d+(\.\d+)?", r[i]) for i in (1, 2, 4, 8))
        return ints or texts or (r[3] is not None and not re.fullmatch(r"\d{4}-\d\d-\d\d|\d\d-\d\d-\d{4}", r[3]))

    if reject_by == "id":
        bad = {r[0] for r in rows if type_dirty(r) and r[0] is not None}
        rows = [r for r in rows if r[0] not in bad]
    else:
        rows = [r for r in rows if not type_dirty(r)]
    rows = [(number(r[0]), r[1], r[2], r[3] and read_date(r[3]), r[4], number(r[5]), number(r[6]), number(r[7]), r[8])
            for r in rows]
    rows = [r for r in rows if None not in r and r[4].lower() not in ("na", "n/a")]
    rows = [r for r in rows if all(r[i] > 0 for i in (0, 5, 6, 7))]

    def char_dirty(r):
        return any(re.search(r"[^a-zA-Z0-9 ]", r[i]) for i in (1, 2, 4, 8))

    if reject_by == "id":
        bad = {r[0] for r in rows if char_dirty(r)}
        rows = [r for r in rows if r[0] not in bad]
    else:
        rows = [r for r in rows if not char_dirty(r)]
    best = {}
    for r in rows:
        h = hashlib.sha256("|".join(str(v) for v in r).encode()).hexdigest()
        if r[0] not in best or (h, r) < best[r[0]]:
            best[r[0]] = (h, r)
    return sorted(r for _, r in best.values() if r[0] not in loaded)


@pytest.mark.parametrize("reject_by", ["id", "row"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_equals_brute_force(spark, reject_by, seed):
    rows = random_rows(160, seed)
    profile = SALES_BATCH.with_options(reject_by=reject_by)
    keys = spark.createDataFrame([(3,), (4,)], "Order_ID int")
    result = sales.run(spark.createDataFrame(rows, all_text(SALES)), profile, STAMP, Workspace(spark, "t"), keys)
    expected = brute_force(rows, {3, 4}, reject_by)
    assert sorted(map(tuple, result.clean.collect())) == expected
    assert len(expected) > 5


def test_ids_written_in_two_ways_are_noticed(spark):
    good = ("7", "Ann", "West", "2024-01-05", "Bolt", "2", "5", "10", "Cash")
    dirty = ("007", *good[1:5], "two", *good[6:])
    flagged = sales.flag_conflicts(
        sales.judge(spark.createDataFrame([good, dirty], all_text(SALES)), SALES_BATCH), SALES_BATCH,
        spark.createDataFrame([], "Customer_Name string"))
    assert not sales.ids_written_one_way(flagged, SALES_BATCH)
    assert sales.settle(flagged, SALES_BATCH).count() == 1


def test_hot_key_and_no_broadcast(spark, monkeypatch):
    """A third of the rows share one id and one customer, a sixth have neither; no key set may be broadcast."""
    monkeypatch.setattr(sales, "is_small", lambda keys: False)
    hot = [("9", "Customer 77", "West", "2024-03-01", "Bolt", "4", "6", "10", "Cash")] * 60
    bare = [(None, None, "West", "2024-03-01", "Bolt", "4", "6", "10", "Cash")] * 30
    rows = random_rows(120, 9) + hot + bare
    keys = spark.createDataFrame([(3,), (3,), (4,)], "Order_ID int")
    result = sales.run(spark.createDataFrame(rows, all_text(SALES)), SALES_BATCH, STAMP, Workspace(spark, "t"), keys)
    assert sorted(map(tuple, result.clean.collect())) == brute_force(rows, {3, 4}, "id")
    shuffled = {tuple(r) for r in result.quarantine.collect()}
    monkeypatch.undo()
    again = sales.run(spark.createDataFrame(rows, all_text(SALES)), SALES_BATCH, STAMP, Workspace(spark, "t"), keys)
    assert {tuple(r) for r in again.quarantine.collect()} == shuffled


def test_size_check(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    assert is_small(keys) and not is_small(keys, max_rows=1) and not is_small(keys, max_bytes=10)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once_from_flagged_to_new(spark):
    """The anti join takes the partitioning and the order of the id aggregate; only the keys move."""
    df = spark.createDataFrame(random_rows(20, 1), all_text(SALES))
    judged = sales.judge(df, SALES_BATCH).withColumn("is_region_conflicts", F.lit(False))
    flagged = Workspace(spark, "t").hold(judged, "f")
    keys = spark.range(10).select(F.col("id").cast("int").alias("Order_ID")).hint("merge")
    plan = plan_of(sales.new_only(sales.settle(flagged, SALES_BATCH, one_text_per_id=True), keys, SALES_BATCH))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_small_load_shuffles_no_target_keys(spark):
    ws = Workspace(spark, "t")
    df = spark.createDataFrame(random_rows(20, 1), all_text(SALES))
    flagged = ws.hold(sales.judge(df, SALES_BATCH).withColumn("is_region_conflicts", F.lit(False)), "f")
    keys = ws.hold(spark.range(1000).select(F.col("id").cast("int").alias("Order_ID")), "keys")
    plan = plan_of(sales.new_only(sales.settle(flagged, SALES_BATCH), keys, SALES_BATCH, ws))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_stream_profile_reports_both_rules(spark):
    good = ("7", "Ann", "West", "2024-01-05", "Bolt", "2", "5", "10", "Cash")
    both = ("8", "Ann", "West", "2024-02-30", "Bolt", "0", "5", "10", "Cash")
    df = spark.createDataFrame([good, both], all_text(SALES))
    stream = sales.run(df, SALES_STREAM, STAMP, Workspace(spark, "t", "memory"))
    assert sorted(r["rule"] for r in stream.quarantine.collect()) == ["negative_values", "null_values"]
    batch = sales.run(df, SALES_BATCH, STAMP, Workspace(spark, "t"))
    assert [r["rule"] for r in batch.quarantine.collect()] == ["null_values"]


def financial_row(**changes):
    base = {n: "5" for n in FINANCIALS.fieldNames()} | {
        "Segment": "Small Business", "Country": "Canada", "Product": "Red Bolt", "Discount Band": "Low",
        "Date": "2014-01-05", "Month Name": "January"}
    return tuple({**base, **changes}[n] for n in FINANCIALS.fieldNames())


def test_financials_rules(spark):
    rows = [
        financial_row(), financial_row(),
        financial_row(**{"Units Sold": "twenty one", "Sale Price": "$1,200", "Date": "2014.01.05"}),
        financial_row(Segment="null"), financial_row(Profit="-5"), financial_row(Product="00045"),
        financial_row(Country="Côte"), financial_row(Segment="X"), financial_row(Profit="abc"),
        financial_row(Date="next week"), financial_row(Profit="0"), financial_row(Year="2014.5"),
    ]
    result = financials.run(spark.createDataFrame(rows, all_text(FINANCIALS)), FINANCIALS_BATCH, STAMP,
                            Workspace(spark, "t"))
    clean = sorted((r["Units Sold"], r["Sale Price"], r["Profit"], r["Date"]) for r in result.clean.collect())
    day = date(2014, 1, 5)
    assert clean == [(5.0, 5.0, 0.0, day), (5.0, 5.0, 5.0, day), (21.0, 1200.0, 5.0, day)]
    counts = {r["rule"]: r["n"] for r in result.quarantine.groupBy("rule").agg(F.count("*").alias("n")).collect()}
    assert counts == {"dirty_dates": 2, "null_values": 1, "negative_values": 1, "numeric_strings": 1,
                      "unknown_chars": 1, "typos": 1, "type_conversion": 3}


def test_batch_job_is_repeatable_and_audited(spark, tmp_path):
    sinks = Sinks(str(tmp_path))
    good = [(str(i), "Ann", "West", "2024-01-05", "Bolt", "2", "5", "10", "Cash") for i in range(1, 6)]
    dirty = [("9", "Bob", "Nrth", "2024-01-05", "Bolt", "2", "5", "10", "Cash")]
    first = spark.createDataFrame(good[:3] + dirty, all_text(SALES))
    second = spark.createDataFrame(good, all_text(SALES))
    counts = run_batch(spark, SALES_BATCH, first, sinks, "2024-01-01", STAMP)
    assert counts == {"raw": 4, "invalid_region": 1, "loaded": 3}
    run_batch(spark, SALES_BATCH, second, sinks, "2024-01-01", STAMP)
    assert sorted(r["Order_ID"] for r in spark.read.parquet(sinks.name).collect()) == [1, 2, 3, 4, 5]
    assert spark.read.parquet(sinks.path("report")).where("stage NOT IN ('raw', 'loaded')").count() == 0
    details = sorted(r["details"] for r in spark.read.parquet(sinks.path("audit")).collect())
    assert details == ["Loaded 2 rows", "Loaded 3 rows"]


def test_failed_batch_is_on_record(spark, tmp_path):
    sinks = Sinks(str(tmp_path))
    broken = spark.createDataFrame([("1",)], "Order_ID string").where(F.raise_error(F.lit("no such luck")).isNull())
    with pytest.raises(Exception, match="no such luck"):
        run_batch(spark, SALES_BATCH, broken, sinks, "2024-01-01", STAMP)
    record = spark.read.parquet(sinks.path("audit")).first()
    assert record["action"] == "ROLLBACK" and "no such luck" in record["details"]


def test_financials_job_keeps_extra_columns(spark, tmp_path):
    sinks = Sinks(str(tmp_path))
    rows = spark.createDataFrame([financial_row()], all_text(FINANCIALS)).withColumn("source_file", F.lit("Financials"))
    run_batch(spark, FINANCIALS_BATCH, rows, sinks, "2024-01-01", STAMP)
    assert spark.read.parquet(sinks.name).columns == [*FINANCIALS.fieldNames(), "source_file"]


def test_rule_tables_have_their_own_layout(spark):
    rows = spark.createDataFrame(random_rows(120, 4), all_text(SALES))
    records = sales.run(rows, SALES_STREAM, STAMP, Workspace(spark, "t", "memory")).quarantine
    for rule in RULES:
        names = rule_table(records, rule, NAMES).columns
        if rule == "typos":
            assert names[:9] == NAMES and names[9:] == [
                "dirty_reason", "column_flagged", "suggested_value", "source_file", "logged_at"]
        elif rule == "region_conflicts":
            assert names == ["issue", "source_file", "logged_at", "row_hash", *[n.lower() for n in NAMES]]
        else:
            assert names[0] in ("issue", "payload") and names[-9:] == NAMES
    sent = to_topics(records)
    assert sent.columns == ["topic", "key", "value"] and sent.where("topic IS NULL").count() == 0


def test_database_sinks(spark, monkeypatch):
    """No database here: what would be written, and where, is recorded instead."""
    written = {}

    def record(self, df, table, mode="append", text=False):
        written[table] = (mode, df.count())

    monkeypatch.setattr(JdbcTarget, "write", record)
    monkeypatch.setattr(JdbcTarget, "read", lambda self, spark, table, **split: spark.createDataFrame(
        [(1, 7, "x")], "Order_ID int, `Row ID` bigint, other string"))
    good = [(str(i), "Ann", "West", "2024-01-05", "Bolt", "2", "5", "10", "Cash") for i in (1, 2)]
    dirty = [("9", "Bob", "Nrth", "2024-01-05", "Bolt", "2", "5", "10", "Cash")]
    sinks = JdbcSinks(JdbcTarget("jdbc:x:y"), "sales", NAMES)
    run_batch(spark, SALES_BATCH, spark.createDataFrame(good + dirty, all_text(SALES)), sinks, "2024-01-31", STAMP)
    assert written["sales"] == ("append", 1) and written["audit_log"] == ("append", 1)
    assert written["dirty_invalid_region_2024_01_31"] == ("overwrite", 1)
    assert written["dirty_null_values_2024_01_31"] == ("overwrite", 0)
    money = JdbcSinks(JdbcTarget("jdbc:x:y"), "financials", FINANCIALS.fieldNames())
    rows = spark.createDataFrame([financial_row(), financial_row(Country="Côte")], all_text(FINANCIALS))
    run_batch(spark, FINANCIALS_BATCH, rows, money, "2024-01-31", STAMP)
    assert written["financials"] == ("append", 1) and written["dirty_unknown_chars_2024_01_31"] == ("overwrite", 1)


def test_records_of_an_unknown_rule_are_refused(spark, monkeypatch):
    monkeypatch.setattr(JdbcTarget, "write", lambda *args, **options: None)
    records = spark.createDataFrame([("new_rule", "x", "h")], "rule string, issue string, row_hash string")
    with pytest.raises(ValueError, match="new_rule"):
        JdbcSinks(JdbcTarget("jdbc:x:y"), "sales", NAMES).quarantine(records, "2024-01-31", "2024-01-31")
    with pytest.raises(Exception, match="no topic for rule new_rule"):
        to_topics(records).collect()
    assert {r["topic"] for r in to_topics(records.withColumn("rule", F.lit("dirty_dates"))).collect()} == {"dirty-dates"}


def test_integers_beyond_doubles(spark):
    ids = ["9007199254740993", "9223372036854775807", "9223372036854775808", "5.0", "1e3", "5.5", "$1,234"]
    rows = spark.createDataFrame([financial_row(**{"Row ID": i}) for i in ids], all_text(FINANCIALS))
    result = financials.run(rows, FINANCIALS_BATCH, STAMP, Workspace(spark, "t"))
    assert sorted(r["Row ID"] for r in result.clean.collect()) == [5, 1000, 1234, 9007199254740993, 9223372036854775807]
    assert sorted(r["Row ID"] for r in result.quarantine.collect()) == ["5.5", "9223372036854775808"]


def test_financials_of_a_day_are_loaded_once(spark, tmp_path):
    rows = spark.createDataFrame([financial_row(**{"Row ID": str(i)}) for i in range(5)], all_text(FINANCIALS))
    for _ in range(2):
        run_batch(spark, FINANCIALS_BATCH, rows, Sinks(str(tmp_path)), "2024-01-31", STAMP)
    assert spark.read.parquet(f"{tmp_path}/target").count() == 5
