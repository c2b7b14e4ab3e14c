"""Steps that must grow with their input: no task or broadcast with all of it, no rule for values that need none."""

import itertools
import random

from pyspark.sql import functions as F

from sievewright.catalog import queries
from sievewright.contracts import FINANCIALS_BATCH
from sievewright.functions import checks, text
from sievewright.functions.text import quoted
from sievewright.operators import rules
from sievewright.plans import financials
from sievewright.storage import Workspace

ODD = ["", " ", "0", "00", "7", "1.5", "1.", ".5", "-3", "+3", "1,200", "$1,200", "1e5", "1994", "123456789012345", "1234567890123456789", "1994-02-28",
       "1994-02-30", "28-02-1994", "0000-01-01", "1994-02-28\n", "Low", "lo", "X", "null", "NULL", "Null", "none", "nan", "NaN", "na", "N/A", "Nan x", "nulls",
       "Country 5", "country  5", "5 country", "a1b", "A1 b2", "o'neil", "José", "a - b", "a-b", "-", "a.b", "abc\n", "abc def\t", " abc ", "twenty one",
       "small business", "ab cd", "abc d", "x" * 120, "abc " * 40 + "abc", "﻿abc", "abc def", "abc?", "abc$", None]


def sales_tables(spark, path, n=240):
    ids = spark.range(n).repartition(4)
    ids.select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.when(F.col("id") % 4 == 0, "F").otherwise("O").alias("o_orderstatus"),
               F.expr("date_add(date'1994-01-01', cast(id % 300 AS int))").alias("o_orderdate")).write.parquet(f"{path}/orders.parquet")
    ids.select(F.col("id").alias("l_orderkey"), (F.col("id") % 9).alias("l_partkey"), (F.col("id") % 7 + 1).cast("double").alias("l_quantity"),
               F.lit(0.05).alias("l_discount")).write.parquet(f"{path}/lineitem.parquet")
    spark.range(9).select(F.col("id").alias("p_partkey"), F.lit("hot bolt").alias("p_name"), (F.col("id") + 900.5).alias("p_retailprice")).write.parquet(
        f"{path}/part.parquet")
    return str(path)


def test_texts_that_begin_alike_do_not_all_meet(spark):
    df = spark.createDataFrame([("cold copper plate 1234", "cold copper plate 9876")], "a string, b string")
    assert df.select(F.size(F.array_intersect(rules.deletions(F.col("a")), rules.deletions(F.col("b"))))).first()[0] == 0
    words = df.select(F.lit("c").alias("column_name"), F.col("b").alias("value"))
    near = rules.near_words(df.select(F.lit("c").alias("column_name"), F.col("a").alias("text")), words)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()


def test_two_edits_leave_a_deletion_in_common(spark):
    rng, pairs = random.Random(5), []
    for _ in range(400):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(17, 30)))
        b = a
        for _ in range(2):
            at, kind = rng.randint(0, len(b)), rng.randrange(3)
            b = b[:at] + (rng.choice("abcdefgh") if kind < 2 else "") + b[at + (kind > 0):]
        pairs.append((a, b))
    common = F.size(F.array_intersect(rules.deletions(F.col("a")), rules.deletions(F.col("b"))))
    assert spark.createDataFrame(pairs, "a string, b string").where(common == 0).collect() == []


def test_malformed_lines_are_written_by_several_tasks(spark, tmp_path):
    got = queries.src_csv_malformed(spark, sales_tables(spark, tmp_path))
    assert len(got.inputFiles()) > 1
    rows = got.collect()
    assert len(rows) == 240 and sum(r["malformed_csv"] is not None for r in rows) == 72
    assert {r["customer"] for r in rows if r["id"] == "14"} == {"14,"} and {r["source_file"] for r in rows} == {"Test_Data"}
    assert {r["malformed_csv"] for r in rows if r["malformed_csv"] and r["malformed_csv"].startswith("13,")} == {'13,"13,F' if 13 % 4 == 0 else '13,"13,O'}


def test_a_bounded_batch_has_several_files(spark, tmp_path, monkeypatch):
    path, results = sales_tables(spark, tmp_path), []
    for rows_per_file, many in ((10**9, False), (10, True)):
        monkeypatch.setattr(queries, "ROWS_PER_STREAM_FILE", rows_per_file)
        ws = Workspace(spark, "batches")
        queries._batches(spark, path, ws, F.coalesce(F.col("Order_ID").try_cast("bigint") % 3, F.lit(0)))
        lines = spark.read.text(ws.path("in"))
        files = lines.inputFiles()
        assert len(files) % 3 == 0 and (len(files) > 3) == many
        results.append(sorted(r["value"] for r in lines.collect()))
    assert results[0] == results[1] and results[0]


def test_plainly_good_values_meet_no_rule(spark):
    fields = FINANCIALS_BATCH.contract.fields
    good = {f.name: v for f, v in zip(fields, itertools.cycle(["7"]))} | {
        n: "Low" for n in checks.text_fields(FINANCIALS_BATCH.contract)} | {"Date": "1994-02-28"}
    rows = [tuple({**good, f.name: v}[n] for n in FINANCIALS_BATCH.columns) for f in fields for v in ODD]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in FINANCIALS_BATCH.columns))
    for profile in (FINANCIALS_BATCH, FINANCIALS_BATCH.with_options(nonpositive_op="<=", min_text_length=5, typo_dictionary={"Segment": ("High",)})):
        judged = df.select("*", financials._first_rule(profile).alias("slow"), financials.leaves_at(profile).alias("quick")).collect()
        assert [r["slow"] for r in judged] == [r["quick"] for r in judged] and len({r["slow"] for r in judged}) > 4
    looked = df.agg(*[F.count_if(checks.plainly_good(f)) for f in fields]).first()
    assert min(looked) > len(rows) * 0.9


def test_quick_looks_clean_as_the_whole_way(spark):
    df = spark.createDataFrame([(v,) for v in [*ODD, "12/31/2024", "a1 2b", "ÉCOLE d'été", "nONE", "abc 12 x3", "1994.05.03"]], "c string")
    c = quoted("c")
    slow_words = text.null_if_cleaning_token(c, F.initcap(text.collapse_spaces(c)))
    assert df.where(~text.title_letters(c).eqNullSafe(text._title_letters(c))).collect() == []
    assert df.where(~text.title_words(c).eqNullSafe(slow_words)).collect() == []
    spaced = c.rlike(checks.SPACED_HYPHEN_PATTERN) | ~c.rlike(checks.CLEAN_TEXT_PATTERN)
    assert df.where(~checks.char_bad("c").eqNullSafe(F.coalesce(spaced, F.lit(False)))).collect() == []


def test_the_financials_set_the_session_as_the_jobs_do(spark):
    df = spark.createDataFrame([tuple("7" for _ in FINANCIALS_BATCH.columns)], ", ".join(f"`{n}` string" for n in FINANCIALS_BATCH.columns))
    old = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    try:
        financials.run(df, FINANCIALS_BATCH, queries.FINANCIALS_STAMP, Workspace(spark, "t"))
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", old)
