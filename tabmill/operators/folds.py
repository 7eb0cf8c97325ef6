"""Hold-out and folds: fixed functions of the id, the same for every model and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.functions.checks import col
from tabmill.operators.ranks import values_at_ranks


def hash_bucket(key: Column, salt: str, buckets: int, missing: Column | None = None) -> Column:
    """0..buckets-1 from 32 bits of an md5 over key and salt; a missing key counts as ``missing``, so no row is without bucket."""
    key = F.coalesce(key.cast("string"), missing if missing is not None else F.lit(""))
    digest = F.md5(F.concat(key, F.lit(salt)))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def _spread(columns: Sequence[str]) -> Column:
    """A text from a few named columns that spreads the rows whose key is missing. Never all columns: an expression
    over a wide table is repeated in every filter on the bucket, and the optimizer does not end over an unstored one."""
    return F.xxhash64(*[col(c) for c in columns]).cast("string") if columns else F.lit("")


def mark_holdout(
    df: DataFrame, key: str, percent: int = 20, seed: int = 42, name: str = "is_holdout", spread_by: Sequence[str] = ()
) -> DataFrame:
    """Flag a share of the rows as hold-out; the salt differs from the one of the folds.

    Rows without key go by the columns of ``spread_by``; without such columns they all get the same flag.
    """
    return df.withColumn(name, hash_bucket(col(key), f"{seed}:split", 100, _spread(spread_by)) < percent)


def assign_folds(
    df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold", spread_by: Sequence[str] = ()
) -> DataFrame:
    """Shuffled folds 0..k-1. Rows without key go by the columns of ``spread_by``; without such columns they share a fold."""
    return df.withColumn(name, hash_bucket(col(key), f"{seed}:fold", k, _spread(spread_by)))


def contiguous_folds(df: DataFrame, key: str, k: int = 5, name: str = "fold") -> DataFrame:
    """Unshuffled folds: runs of the rows in key order, the first n % k folds one row longer.

    Only the k - 1 keys at which a new fold starts are looked up; the rows themselves are
    neither sorted nor shuffled. Keys must be unique; missing ones come first and lie in one fold, the first, with the
    rows that follow them.
    """
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(col(key).isNull()).alias("missing")).first()
    n, missing = counted["rows"], counted["missing"]
    starts, position = [], 0
    for f in range(k - 1):
        position += n // k + (1 if f < n % k else 0)
        if position < n:
            starts.append(max(position - missing, 0))
    cuts = values_at_ranks(df, key, starts) if n > missing else []
    fold = F.lit(0)
    for cut in cuts:
        fold = fold + F.coalesce((col(key) >= F.lit(cut)).cast("int"), F.lit(0))
    return df.withColumn(name, fold)
