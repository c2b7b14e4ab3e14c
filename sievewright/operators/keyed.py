"""Semi and anti joins against key sets: rejection by id, customers in conflict, keys already loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.functions.text import backticked, quoted

#: Keys are split into this many pieces at most, however many shuffle partitions there are.
MOST_PIECES = 1_000


def hot_keys(df: DataFrame, on: str) -> dict[object, int]:
    """The keys with more rows than a shuffle partition has on average, and into how many pieces to split each, by a sketch of frequent
    items over one column. There are fewer of them than partitions. Keys the sketch takes for larger than they are do no harm."""
    parts = max(2, min(MOST_PIECES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    named = df.select(quoted(on).alias("k")).where("k IS NOT NULL")
    found = named.agg(F.expr(f"approx_top_k(k, {parts}, {32 * parts})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return {}
    pieces = {r["item"]: min(parts, -(-r["count"] * parts // found["n"])) for r in found["top"]}
    return {k: n for k, n in pieces.items() if n > 1}


def _key_join(df: DataFrame, keys: DataFrame, on: str, how: str, hot: dict[object, int] | None, salts: int = 1) -> DataFrame:
    """Join on one key. Without ``hot`` and ``salts``: as Spark does it. ``salts`` deals the rows of every key to that many pieces. With ``hot`` the rows of a hot key are dealt to that many pieces by their position, and
    its row of ``keys`` is repeated for each; copies of a row go to different pieces too. Rows with a NULL key match nothing and are dealt to
    as many pieces as there may be, so that they do not meet in one task."""
    if hot is None and salts == 1:
        return df.join(keys, quoted(on) == keys["__k"], how)
    place, pieces = F.monotonically_increasing_id(), F.lit(salts)
    salt = F.when(quoted(on).isNull(), F.pmod(place, F.lit(MOST_PIECES)))
    for key, n in (hot or {}).items():
        salt = salt.when(quoted(on) == F.lit(key), F.pmod(place, F.lit(n)))
        pieces = F.when(F.col("__k") == F.lit(key), n).otherwise(pieces)
    keys = keys.withColumn("__s", F.explode(F.sequence(F.lit(0), pieces - 1)))
    salted = df.withColumn("__salt", salt.otherwise(F.pmod(place, F.lit(salts)) if salts > 1 else 0).cast("int"))
    return salted.join(keys, (quoted(on) == keys["__k"]) & (F.col("__salt") == keys["__s"]), how)


def _named(keys: DataFrame, key: str) -> DataFrame:
    return keys.select(quoted(key).alias("__k"))


def keep_listed(df: DataFrame, keys: DataFrame, on: str, key: str | None = None, salts: int = 1,
                hot: dict[object, int] | None = None) -> DataFrame:
    """Semi join. ``hot``: see :func:`hot_keys`."""
    joined = _key_join(df, _named(keys, key or on), on, "left_semi", hot, salts)
    return joined.select(*[backticked(c) for c in df.columns])


def drop_listed(df: DataFrame, keys: DataFrame, on: str, key: str | None = None, salts: int = 1, split_nulls: bool = False,
                hot: dict[object, int] | None = None) -> DataFrame:
    """Anti join; a NULL key never matches, so such rows stay. ``hot``: see :func:`hot_keys`.

    All NULL keys hash alike. With ``split_nulls`` rows without a key stay out of the join and its shuffle; the
    rows are read twice for that, so they should be a held table.
    """
    right = _named(keys, key or on)
    if split_nulls:
        joined = _key_join(df.where(quoted(on).isNotNull()), right, on, "left_anti", hot, salts)
        return joined.select(*[backticked(c) for c in df.columns]).unionAll(df.where(quoted(on).isNull()))
    joined = _key_join(df, right, on, "left_anti", hot, salts)
    return joined.select(*[backticked(c) for c in df.columns])


def flag_listed(df: DataFrame, unique_keys: DataFrame, on: str, flag: str, salts: int = 1,
                hot: dict[object, int] | None = None) -> DataFrame:
    """Add a boolean column: is the key listed? One outer join serves both the kept and the listed rows. ``hot``: see :func:`hot_keys`."""
    right = _named(unique_keys, unique_keys.columns[0]).withColumn("__hit", F.lit(True))
    joined = _key_join(df, right, on, "left_outer", hot, salts)
    return joined.select(*[backticked(c) for c in df.columns], F.coalesce("__hit", F.lit(False)).alias(flag))


def conflicting_keys(df: DataFrame, key: str, attribute: str, domain=()) -> DataFrame:
    """Keys that appear with more than one non-null value of ``attribute``.

    With a known domain of at most 60 values only these count, and each is one bit of an integer; otherwise the smallest and the largest of
    two hashes of the value are compared (96 bits together). Either way the aggregate is a hash table of numbers, and no distinct set is
    built.
    """
    key_col, value = quoted(key), quoted(attribute)
    if domain:
        if len(domain) > 60:
            known = F.when(value.isin(*domain), value)
            return conflicting_keys(df.select(key_col.alias(key), known.alias(attribute)), key, attribute)
        return seen_values(df, key, attribute, domain).where(F.bit_count("seen") > 1).select(quoted(key))
    rows = df.where(key_col.isNotNull() & value.isNotNull())
    hashes = {"a": F.xxhash64(value), "b": F.hash(value)}
    ends = [fn(h).alias(f"__{end}_{n}") for n, h in hashes.items() for end, fn in (("lo", F.min), ("hi", F.max))]
    grouped = rows.groupBy(key_col.alias(key)).agg(*ends)
    return grouped.where("__lo_a <> __hi_a OR __lo_b <> __hi_b").select(quoted(key))


def seen_values(df: DataFrame, key: str, attribute: str, domain) -> DataFrame:
    """Every key and ``seen``, an integer with a bit for each value of the domain that the key appears with. 60 values at most."""
    key_col, value = quoted(key), quoted(attribute)
    # No filter before the aggregate: it would be pushed below the cleaning and repeat that work.
    bit = F.lit(0).cast("bigint")
    for i, v in enumerate(domain):
        bit = F.when(value == v, F.lit(1 << i).cast("bigint")).otherwise(bit)
    bit = F.when(key_col.isNull(), F.lit(0).cast("bigint")).otherwise(bit)
    return df.groupBy(key_col.alias(key)).agg(F.bit_or(bit).alias("seen"))
