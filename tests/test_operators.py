import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sievewright.contracts import (
    DIRTY_METADATA,
    FINANCIALS,
    FINANCIALS_BATCH,
    SALES,
    SALES_BATCH,
    all_text,
    contract_from_names,
)
from sievewright.functions.identity import row_hash
from sievewright.operators import dedup, keyed, rules, schema
from sievewright.operators.rules import Stamp
from sievewright.storage import Workspace

STAMP = Stamp(datetime(2024, 1, 1), "file.csv")
GOOD = ("1", "Ann Lee", "West", "2024-01-05", "Bolt", "2", "5", "10", "Cash")


def sales_rows(spark, *changes):
    """Rows like GOOD with some columns replaced."""
    names = SALES.fieldNames()
    rows = [tuple(change.get(n, g) for n, g in zip(names, GOOD)) for change in changes]
    return spark.createDataFrame(rows, all_text(SALES))


def test_align_and_enforce(spark):
    df = spark.createDataFrame([("x", "7", "n")], "extra string, Order_ID string, Region string")
    assert schema.align(df, SALES).columns == SALES.fieldNames()
    assert schema.align(df, SALES, extras="keep").columns == [*SALES.fieldNames(), "extra"]
    enforced = schema.enforce(df, SALES)
    assert enforced.schema == SALES and enforced.first()["Order_ID"] == 7
    with pytest.raises(ValueError):
        schema.align(df, SALES, extras="?")


def test_enforce_bad_text_is_null_under_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert schema.enforce(sales_rows(spark, {"Quantity": "abc"}), SALES).first()["Quantity"] is None


def test_key_of_a_profile_is_in_its_contract():
    assert SALES_BATCH.key == "Order_ID" and FINANCIALS_BATCH.key == "Row ID"
    with pytest.raises(ValueError):
        SALES_BATCH.with_options(key="order")


def test_conflicts_of_a_large_domain(spark):
    df = spark.createDataFrame([(k, f"v{(k * 7 + i) % 80}") for k in range(6) for i in range(1 + k % 2)] + [(1, "unknown"), (2, "unknown")], "k int, v string")
    domain = tuple(f"v{i}" for i in range(80))
    assert {r[0] for r in keyed.conflicting_keys(df, "k", "v", domain).collect()} == {1, 3, 5}


def test_normalize_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`  Row   ID ` int, B int")
    assert schema.normalize_headers(df).columns == ["row id", "b"]
    assert schema.strip_headers(df).columns == ["Row   ID", "B"]


def test_date_columns(spark):
    df = spark.createDataFrame([("x", "seen 2024/1/5"), ("y", None)], "a string, b string")
    assert [r[0] for r in schema.detect_date_columns(df).collect()] == ["b"]
    assert [r[0] for r in schema.detect_date_columns(df, FINANCIALS).collect()] == ["Date"]


def test_to_text_lists_as_json(spark):
    row = schema.to_text(spark.createDataFrame([(["a", "b"], 1)], "l array<string>, n int")).first()
    assert tuple(row) == ('["a","b"]', "1")


def test_union_by_name_is_strict(spark):
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int")
    with pytest.raises(Exception):
        schema.union_by_name([a, b]).collect()
    assert schema.union_by_name([a, b], allow_missing=True).count() == 2


def test_one_per_key_is_smallest_row(spark):
    df = spark.createDataFrame([("k", "b", 2), ("k", "a", 3), (None, "z", 1), (None, "y", None)], "k string, a string, n int")
    got = {(r["k"], r["a"]) for r in dedup.one_per_key(df, "k").collect()}
    assert got == {("k", "a"), (None, "y")}


def test_conflicts_with_and_without_domain_agree(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), (None, "x"), (None, "y"), ("c", None), ("c", "y")], "k string, v string")
    plain = {r[0] for r in keyed.conflicting_keys(df, "k", "v").collect()}
    bits = {r[0] for r in keyed.conflicting_keys(df, "k", "v", ("x", "y")).collect()}
    assert plain == bits == {"b"}


def test_null_keys_survive_anti_join(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, n int")
    keys = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert sorted(r["n"] for r in keyed.drop_listed(df, keys, "k").collect()) == [2, 3]
    assert [r["n"] for r in keyed.keep_listed(df, keys, "k").collect()] == [1]
    flagged = keyed.flag_listed(df, keys.where("k is not null").distinct(), "k", "hit").collect()
    assert {(r["n"], r["hit"]) for r in flagged} == {(1, True), (2, False), (3, False)}


def test_salted_joins_give_the_same_rows(spark):
    """One key and the missing key hold most rows, copies included."""
    df = spark.createDataFrame([("hot", i % 3) for i in range(40)] + [(None, 1)] * 30 + [("b", 7)], "k string, n int")
    keys = spark.createDataFrame([("hot",), ("x",)], "k string")

    def rows(frame):
        return sorted(map(tuple, frame.collect()), key=str)

    for salts in ({"salts": 5}, {"split_nulls": True}):
        assert rows(keyed.drop_listed(df, keys, "k", **salts)) == rows(keyed.drop_listed(df, keys, "k"))
    assert rows(keyed.keep_listed(df, keys, "k", salts=5)) == rows(keyed.keep_listed(df, keys, "k"))
    assert rows(keyed.flag_listed(df, keys, "k", "hit", 5)) == rows(keyed.flag_listed(df, keys, "k", "hit"))


def test_contract_from_type_names():
    contract = contract_from_names({"a": "int64", "d": "date", "x": "mystery"}, DIRTY_METADATA)
    kinds = [f.dataType.simpleString() for f in contract.fields]
    assert kinds[:3] == ["bigint", "date", "string"] and len(kinds) == 3 + len(DIRTY_METADATA)
    assert contract["logged_at"].dataType.simpleString() == "timestamp"


def test_region_rules(spark):
    df = sales_rows(spark, {}, {"Region": "Nrth"}, {"Region": None}, {"Region": "Nrth"})
    found = rules.invalid_region(df, SALES_BATCH, STAMP).collect()
    assert len(found) == 1 and found[0]["column_flagged"] == "Region"


def test_null_rule(spark):
    df = sales_rows(spark, {"Region": "Na", "Product": None}, {"Product": "Canada"})
    found = rules.nulls(df, SALES_BATCH, STAMP).collect()
    assert [(r["null_columns"], r["Region"]) for r in found] == [(["Region", "Product"], None)]
    strict = rules.nulls(df, SALES_BATCH.with_options(case_sensitive_tokens=True), STAMP).collect()
    assert [r["null_columns"] for r in strict] == [["Product"]]


def test_nonpositive_rule(spark):
    df = sales_rows(spark, {"Quantity": "0", "Unit_Price": "-1"}, {})
    assert rules.nonpositive(df, SALES_BATCH, STAMP).first()["negative_columns"] == ["Quantity", "Unit_Price"]


def test_type_rules(spark):
    df = sales_rows(spark, {"Quantity": "two", "Product": "12.5"}, {"Unit_Price": "$1,200"}, {})
    rows = {r["dirty_columns"]: r["dirty_values"] for r in rules.type_dirty_rows(df, SALES_BATCH, STAMP).collect()}
    assert rows == {"Product,Quantity": "12.5,two", "Unit_Price": "$1,200"}
    cells = {(r["dirty_columns"], r["error_type"]) for r in rules.type_dirty_cells(df, SALES_BATCH, STAMP).collect()}
    assert cells == {("Product", "STRING_NUMERIC_MIX"), ("Quantity", "INVALID_INTEGER"), ("Unit_Price", "INVALID_INTEGER")}


def test_character_rule(spark):
    df = sales_rows(spark, {"Customer_Name": "José"}, {"Product": "a - b"}, {"Product": "x​y", "Region": "W!"}, {})
    issues = {r["issue"] for r in rules.special_chars(df, SALES_BATCH, STAMP).collect()}
    assert issues == {
        "Invalid leading/trailing char in Customer_Name | Non-ASCII character detected in Customer_Name",
        "Invalid characters in Product",
        "Invalid leading/trailing char in Region | Contains special char in Product",
    }


def test_character_rule_with_skipped_name(spark):
    profile = SALES_BATCH.with_options(skip_chars=("Customer_Name",))
    df = sales_rows(spark, {"Customer_Name": "José"}, {"Customer_Name": "a!"})
    assert [r["issue"] for r in rules.special_chars(df, profile, STAMP).collect()] == [
        " | Non-ASCII character detected in Customer_Name"]


def test_described_characters(spark):
    row = tuple("​x " if n == "Product" else "1" for n in FINANCIALS.fieldNames())
    found = rules.special_chars_described(spark.createDataFrame([row], all_text(FINANCIALS)), FINANCIALS_BATCH, STAMP).first()
    assert found["issue"] == "Contains special char(s) in Product: zero-width space, non-breaking space"
    assert found["column_flagged"] == "Product" and found["bad_value"] == "Product: ​x "


def test_bigint_rule_sees_overflow(spark):
    df = sales_rows(spark, {"Order_ID": "x1"}, {"Order_ID": "9" * 25}, {"Order_ID": None}, {})
    assert {r["dirty_value"] for r in rules.bigint(df, "Order_ID", STAMP).collect()} == {"x1", "9" * 25}


def test_doubtful_text_reasons_per_row(spark):
    rows = [tuple({"Segment": s}.get(n, "abcd") for n in FINANCIALS.fieldNames()) for s in ("X", "a  b", "fine")]
    found = rules.doubtful_text(spark.createDataFrame(rows, all_text(FINANCIALS)), FINANCIALS_BATCH, STAMP).collect()
    assert {(r["Segment"], r["dirty_reason"]) for r in found} == {
        ("X", "Too short (<3) in 'Segment'"), ("a  b", "Contains double spaces in 'Segment'")}


def test_row_rules_conserve_rows(spark):
    """Kept and removed rows of a row rule are the input again."""
    df = sales_rows(spark, {}, {"Quantity": "0"}, {"Quantity": "-4"}, {"Quantity": "x"})
    from sievewright.functions import checks
    bad = checks.any_of([checks.nonpositive(n) for n in checks.numeric_fields(SALES)])
    kept, removed = df.where(~bad), df.where(bad)
    assert sorted(map(tuple, kept.union(removed).collect())) == sorted(map(tuple, df.collect()))
    assert removed.count() == 2


def first_steps(df, *columns):
    """Names of the operators between a scan of these columns and the first shuffle, on every path of the plan."""
    scan = r"FileScan parquet \[" + ",".join(rf"{c}#\d+" for c in columns) + r"\]"
    names, path = set(), []
    for line in df._jdf.queryExecution().sparkPlan().toString().splitlines():
        text = line.lstrip(" :+-")
        depth, name = len(line) - len(text), text.split(" ")[0].split("(")[0]
        path = [(d, n) for d, n in path if d < depth] + [(depth, name)]
        if re.search(scan, line):
            steps = [n for _, n in path]
            names |= set(steps[max((i for i, n in enumerate(steps) if "Exchange" in n), default=0):])
    return names


def test_dedup_in_two_phases(spark):
    ws = Workspace(spark, "t")
    rng = random.Random(3)
    rows = [(str(rng.randint(1, 300)) if rng.random() < 0.97 else None, rng.choice("abc"), rng.choice([1, 2, None])) for _ in range(600)]
    rows += [("hot", "a", 1)] * 300 + [("hot", "b", k) for k in range(30)]
    df = ws.hold(spark.createDataFrame(rows, "k string, a string, n int"), "rows")
    plain = sorted(dedup.dedup_primary_key(df, "k").collect(), key=repr)
    phased = dedup.dedup_primary_key(df, "k", workspace=Workspace(spark, "t"))
    assert sorted(phased.collect(), key=repr) == plain and len(plain) > 200
    assert "SortAggregate" in first_steps(dedup.dedup_primary_key(df, "k"), "k", "a", "n")
    assert "FileScan" in first_steps(phased, "k", "a", "n") and not {"Sort", "SortAggregate"} & first_steps(phased, "k", "a", "n")
    hashed = ws.hold(df.select("*", row_hash(["a", "n"]).alias("row_hash")), "hashed")
    assert sorted(dedup.dedup_row_hash(hashed, Workspace(spark, "t")).collect(), key=repr) == sorted(dedup.dedup_row_hash(hashed).collect(), key=repr)


def test_two_phases_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dedup, "is_small", lambda keys: False)
    df = Workspace(spark, "t").hold(spark.createDataFrame([("k", "b"), ("k", "a"), (None, "z"), (None, "y")], "k string, a string"), "rows")
    got = dedup.dedup_primary_key(df, "k", workspace=Workspace(spark, "t")).collect()
    assert sorted(got, key=repr) == sorted(dedup.dedup_primary_key(df, "k").collect(), key=repr)


def test_hot_keys_are_measured(spark):
    rows = [("hot",)] * 500 + [("warm",)] * 200 + [(f"k{i}",) for i in range(300)] + [(None,)] * 900
    df = spark.createDataFrame(rows, "k string")
    found = keyed.hot_keys(df, "k")
    assert found["hot"] >= 4 and found["warm"] >= 2 and not {k for k in found if k not in ("hot", "warm")}
    assert keyed.hot_keys(df.where("k IS NULL"), "k") == {} == keyed.hot_keys(df.where("k LIKE 'k%'"), "k")


def test_exact_copies_of_a_hot_key_spread(spark):
    """A third of the rows are copies of one row, another third have no key: no task gets much more than its share."""
    n = 3000
    df = spark.range(3 * n, numPartitions=6).select(
        F.when(F.col("id") < n, "hot").when(F.col("id") < 2 * n, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.lit(1).alias("v"))
    keys = spark.createDataFrame([("hot",), ("k8000",)], "k string").hint("merge")
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        for join, expected in ((keyed.flag_listed(df, keys, "k", "hit", hot=keyed.hot_keys(df, "k")), 3 * n),
                               (keyed.drop_listed(df, keys, "k", hot=keyed.hot_keys(df, "k")), 2 * n - 1),
                               (keyed.keep_listed(df, keys, "k", hot=keyed.hot_keys(df, "k")), n + 1)):
            sizes = [r["count"] for r in join.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == expected and max(sizes) < 3 * expected / 24 + 100
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_typo_table_equals_all_pairs(spark):
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcé ") for _ in range(rng.randint(0, 22))) for _ in range(150)})
    texts = sorted({*words[::3], *("".join(rng.choice("abcé ") for _ in range(rng.randint(0, 22))) for _ in range(100)),
                    *(w[:k] + w[k + 1:] for w in words for k in (0, len(w) // 2, len(w))), *(w[:3] + "x" + w[3:] + "y" for w in words)})
    df = spark.createDataFrame([(t, str(i)) for i, t in enumerate([*texts, None])], "c string, id string")
    dictionary = spark.createDataFrame([("c", w.upper()) for w in words] + [("c", None), ("other", "x")], "column_name string, value string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for flag_valid in (False, True):
        got = {(r["c"], r["suggested_value"]) for r in rules.typos_by_table(df, dictionary, STAMP, Workspace(spark, "t"), flag_valid=flag_valid).collect()}
        known = set(words)
        assert got == {(t, w.upper()) for t in texts if flag_valid or t.lower() not in known for w in words
                       if t.lower() != w and abs(len(t) - len(w)) <= 2 and distance(t.lower(), w) <= 2}
        assert got
    assert rules.typos_by_table(df, dictionary.where("column_name = 'other'"), STAMP, Workspace(spark, "t")).count() == 0
