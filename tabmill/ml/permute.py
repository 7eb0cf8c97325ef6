"""Importance of columns to any fitted model: how much worse it predicts when the values of one column change places.

Rows are paired by hash: within buckets of a few thousand rows that the hash of their key picks at random, each takes its values from the next one in the order
of the hash, the last from the first. So one sort of a bucket pairs the rows for all columns, and no order over the whole table is needed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmill.functions.checks import col, require_columns
from tabmill.session import discard, materialize

ROWS_TOGETHER = 10_000
_PARTNER, _TURN = "_partner_row", "_turn"


def paired(df: DataFrame, columns: Sequence[str], key: str, seed: int = 42, rows_together: int = ROWS_TOGETHER) -> DataFrame:
    """The table with ``_partner_row``: the named columns (as ``c0``, ``c1``, ...) of another row; every row is the partner of one.

    The hash is an md5 of key and seed, so the pairs do not depend on partitioning. Rows without key go by the values of the named columns; rows of equal
    hash are ordered by those values. A bucket of one row is its own partner.
    """
    buckets = max(1, math.ceil(df.count() / rows_together))
    values = F.xxhash64(*[col(c) for c in columns])
    name = F.coalesce(col(key).cast("string"), F.concat(F.lit("row "), values.cast("string")))
    digest = F.md5(F.concat(name, F.lit(f"{seed}:pairs")))
    hashed = df.withColumns({"_digest": digest, "_values": values})
    bucket = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("bigint") % buckets
    around = Window.partitionBy("_bucket").orderBy("_digest", "_values")
    row = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    partner = F.coalesce(F.lead(row).over(around), F.first(row).over(around))
    return hashed.withColumn("_bucket", bucket).withColumn(_PARTNER, partner).drop("_digest", "_values", "_bucket")


def permutation_importances(
    model: Transformer | Callable[[DataFrame], DataFrame], df: DataFrame, label: str, columns: Sequence[str], key: str,
    seed: int = 42, rows_together: int = ROWS_TOGETHER,
) -> DataFrame:
    """feature, n, rmse, importance — one row per named column; ``importance`` is the growth of the RMSE over all rows with a label.

    ``model`` is a fitted transformer, or a function, that adds ``prediction``. The rows are scored in one pass: each as it is and once for every column with
    its partner's value. Rows without label or prediction do not count; no rows give NULL.
    """
    columns = list(columns)
    require_columns(df, [label, key, *columns], "table")
    clashes = sorted({_PARTNER, _TURN, "_digest", "_values", "_bucket", "prediction"} & set(df.columns))
    if clashes:
        raise ValueError(f"the table has columns of these names already: {clashes}")
    stored = materialize(paired(df.where(col(label).isNotNull()), columns, key, seed, rows_together), "paired")
    try:
        turns = stored.withColumn(_TURN, F.explode(F.array(*[F.lit(i) for i in range(-1, len(columns))])))
        swapped = turns.withColumns({
            c: F.when(F.col(_TURN) == i, F.col(f"{_PARTNER}.c{i}")).otherwise(col(c)) for i, c in enumerate(columns)
        }).drop(_PARTNER)
        scored = model.transform(swapped) if isinstance(model, Transformer) else model(swapped)
        error = F.pow(col(label).cast("double") - F.col("prediction"), F.lit(2))
        # one row per column, and one for the rows as they are
        found = {r[_TURN]: r for r in scored.groupBy(_TURN).agg(F.count(error).alias("n"), F.sqrt(F.avg(error)).alias("rmse")).collect()}
    finally:
        discard(stored)
    plain = found[-1]["rmse"] if -1 in found else None
    rows = []
    for i, c in enumerate(columns):
        n, rmse = (found[i]["n"], found[i]["rmse"]) if i in found else (0, None)
        rows.append((c, n, rmse, rmse - plain if rmse is not None and plain is not None else None))
    return df.sparkSession.createDataFrame(rows, "feature string, n bigint, rmse double, importance double")
