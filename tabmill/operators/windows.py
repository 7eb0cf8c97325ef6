"""Latest row per key, best row per group, top rows per group, latest row overall.

All per-group choices are ``row_number() <= n`` filters. Spark then limits each group within
every input partition before the shuffle (``WindowGroupLimit``), so a key that holds a third
of the table sends at most n rows per partition to the task that decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_rank"


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group; never more, so ``order`` should be total.

    Beyond the ``n`` up to which Spark limits groups before the shuffle, each group is first cut down in as many hashed splits
    as a shuffle has partitions; equal rows of different input partitions fall in different splits.
    """
    conf = df.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
        split = F.pmod(hashed, F.lit(int(conf.get("spark.sql.shuffle.partitions"))))
        df = _first_rows(df.withColumn("_split", split), [*keys, "_split"], order, n).drop("_split")
    return _first_rows(df, keys, order, n)


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def dedup_latest(df: DataFrame, keys: Sequence[str], at: str, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the latest; rows without a time come last.

    Where no tie-break is given, all remaining columns decide, so that equal times give the
    same row in every run.
    """
    if not tie_break:
        tie_break = [F.col(c).asc_nulls_first() for c in df.columns if c not in {*keys, at}]
    return top_per_group(df, keys, [F.col(at).desc_nulls_last(), *tie_break], 1)


def first_row(df: DataFrame, *order: Column) -> DataFrame:
    """The single first row; each partition sends one row only."""
    return df.orderBy(*order).limit(1)


def latest_row(df: DataFrame, at: str, *tie_break: Column, missing_wins: bool = True) -> DataFrame:
    """The row with the latest time. A row without a time counts as the latest of all unless
    ``missing_wins`` is off."""
    time = F.col(at).desc_nulls_first() if missing_wins else F.col(at).desc_nulls_last()
    return first_row(df, time, *tie_break)


def head(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
