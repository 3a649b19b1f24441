"""Primary-key uniqueness and NOT NULL checks as distributed queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def null_key_violations(df: DataFrame, keys) -> DataFrame:
    """Rows with a NULL in any key column, plus the list of NULL keys."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    names = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))
    return df.where(any_null).withColumn("null_keys", F.array_join(names, ","))


class KeyViolation(ValueError):
    pass


def assert_keys_valid(df: DataFrame, keys, sample: int = 20) -> None:
    """Fail like the database would on a duplicate or NULL key.

    One aggregate, combined before the shuffle; only up to ``sample`` offending
    keys reach the driver for the error message.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where((F.col("n_rows") > 1) | any_null)
           .withColumn("null_key", any_null).take(sample))
    raise_violations(keys, bad)


def raise_violations(keys, bad) -> None:
    """``bad`` holds rows of the keys, ``n_rows`` and ``null_key``."""
    if bad:
        what = "NULL in" if any(r["null_key"] for r in bad) else "duplicate"
        raise KeyViolation(f"{what} key {list(keys)}: {[r.asDict() for r in bad]}")
