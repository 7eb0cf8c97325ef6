"""Exact order statistics without sorting the table and without holding a group in one task.

A target asks for the value at a rank of one column, taken over all rows or over all rows but
those of one part (a fold). Every round counts the rows of the current intervals by bins, which
Spark sums up within each input partition, keeps for each target the bin its rank falls into,
and looks closer there. Once an interval has few enough distinct values it is counted by value.
What crosses a shuffle or reaches the driver is bounded by targets and bins, not by rows.

Both ways of counting give the same values for every type that has an order: numbers, times and text are put in bins by a
number that never decreases with the value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.functions.checks import col
from tabmill.operators.profile import long_form

BINS = 512
# Distinct values of an interval that are counted one by one instead of by bins.
COUNT_VALUES_UP_TO = 100_000
# Distinct values of a column, as estimated, that one aggregation buffer may hold.
BUFFER_VALUES_UP_TO = 500_000
# Parts (folds) a table may have; one row for each and column reaches the driver.
MOST_PARTS = 10_000

_NO_PART = -1


def _located(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target the bin that holds its rank.

    ``counts``: column, interval, bin, part, n, lo, hi; ``targets``: column, interval, skip, rank.
    A group of the window has at most as many rows as an interval has bins.
    """
    skips = targets.select("column", "interval", "skip").distinct()
    seen = (
        counts.join(F.broadcast(skips), ["column", "interval"])
        .where(F.col("part") != F.col("skip"))
        .groupBy("column", "interval", "skip", "bin")
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    upto = Window.partitionBy("column", "interval", "skip").orderBy("bin")
    running = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        seen.withColumn("upto", F.sum("n").over(running))
        .join(F.broadcast(targets), ["column", "interval", "skip"])
        .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        .select("column", "interval", "skip", "rank", (F.col("rank") - F.col("upto") + F.col("n")).alias("inner"), "n", "lo", "hi")
    )


def _spans(cells: DataFrame) -> dict[str, dict]:
    """Per column: rows of each part, smallest and largest value, estimated distinct values."""
    rows = cells.groupBy("column", "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.approx_count_distinct("value").alias("levels"),
    )
    found = rows.limit(MOST_PARTS + 1).collect()
    if len(found) > MOST_PARTS:
        raise ValueError(f"more than {MOST_PARTS} parts and columns: the part must be a fold")
    spans: dict[str, dict] = {}
    for r in found:
        s = spans.setdefault(r["column"], {"parts": {}, "lo": r["lo"], "hi": r["hi"], "levels": 0})
        s["parts"][r["part"]] = r["n"]
        s["lo"], s["hi"] = min(s["lo"], r["lo"]), max(s["hi"], r["hi"])
        s["levels"] += r["levels"]
    return spans


def _select(
    cells: DataFrame, span: dict[str, dict], wanted: list[tuple[str, int, int]], bins: int, count_up_to: int
) -> dict:
    """(column, skip, rank) -> value. ``cells``: column, part, value (present values only)."""
    spark = cells.sparkSession
    value_type = cells.schema["value"].dataType
    target_schema = "column string, interval int, skip int, rank bigint"
    interval_schema = T.StructType(
        [
            T.StructField("column", T.StringType()),
            T.StructField("interval", T.IntegerType()),
            T.StructField("lo_at", value_type),
            T.StructField("hi_at", value_type),
            T.StructField("by_value", T.BooleanType()),
            T.StructField("skip_bytes", T.IntegerType()),
        ]
    )
    done: dict[tuple[str, int, int], object] = {}
    # open targets: key -> (rank within the interval, lo, hi, rows or levels in it)
    open_targets = {
        (c, skip, rank): (rank, span[c]["lo"], span[c]["hi"], span[c]["levels"]) for c, skip, rank in wanted
    }
    while open_targets:
        places = {
            place: i
            for i, place in enumerate(sorted({(key[0], lo, hi) for key, (_, lo, hi, _) in open_targets.items()}))
        }
        small = {}
        for key, (_, lo, hi, size) in open_targets.items():
            place = (key[0], lo, hi)
            small[place] = max(small.get(place, 0), size)
        intervals = spark.createDataFrame(
            [(c, i, lo, hi, small[(c, lo, hi)] <= count_up_to, _common_bytes(lo, hi)) for (c, lo, hi), i in places.items()],
            interval_schema,
        )
        lookup: dict[tuple[int, int, int], list] = {}
        for key, (rank, lo, hi, _) in open_targets.items():
            lookup.setdefault((places[(key[0], lo, hi)], key[1], rank), []).append(key)
        names = {i: c for (c, _, _), i in places.items()}
        targets = spark.createDataFrame(
            [(names[i], i, skip, rank) for (i, skip, rank) in lookup], target_schema
        )
        inside = cells.join(
            F.broadcast(intervals),
            (cells["column"] == intervals["column"]) & (cells["value"] >= F.col("lo_at")) & (cells["value"] <= F.col("hi_at")),
        ).select(cells["column"], "part", "value", "interval", "by_value", "lo_at", "hi_at", "skip_bytes")
        found = []
        if any(small[p] > count_up_to for p in places):
            binned = (
                inside.where(~F.col("by_value"))
                .withColumn("bin", _bin(F.col("value"), F.col("lo_at"), F.col("hi_at"), value_type, bins))
                .groupBy("column", "interval", "bin", "part")
                .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            )
            found += _located(binned, targets).collect()
        if any(small[p] <= count_up_to for p in places):
            by_value = (
                inside.where("by_value")
                .groupBy("column", "interval", F.col("value").alias("bin"), "part")
                .agg(F.count(F.lit(1)).alias("n"))
                .withColumns({"lo": F.col("bin"), "hi": F.col("bin")})
            )
            found += _located(by_value, targets).collect()
        remaining = {}
        for r in found:
            for key in lookup[(r["interval"], r["skip"], r["rank"])]:
                if r["lo"] == r["hi"]:
                    done[key] = r["lo"]
                else:
                    remaining[key] = (r["inner"], r["lo"], r["hi"], r["n"])
        open_targets = remaining
    return done


def _common_bytes(lo: object, hi: object) -> int:
    """Bytes that all texts between the two begin with; 0 for other values."""
    if not isinstance(lo, str) or not isinstance(hi, str):
        return 0
    pairs = zip(lo.encode(), hi.encode(), strict=False)
    return next((i for i, (a, b) in enumerate(pairs) if a != b), min(len(lo.encode()), len(hi.encode())))


def _bin(value: Column, lo: Column, hi: Column, value_type: T.DataType, bins: int) -> Column:
    """Equal-width bin; never decreases with the value, and both ends get bins of their own."""
    share = _distance(value, lo, value_type) / _distance(hi, lo, value_type)
    inner = F.floor(F.nanvl(share, F.lit(0.5)) * bins).cast("int")
    return F.when(value <= lo, 0).when(value >= hi, bins - 1).otherwise(F.least(inner, F.lit(bins - 1)))


def _distance(value: Column, origin: Column, value_type: T.DataType) -> Column:
    """Distance as double, without overflow for integers. ``value`` lies at or above ``origin``, and both in an interval."""
    if isinstance(value_type, T.StringType):
        return _text_number(value) - _text_number(origin)
    if isinstance(value_type, T.DateType):
        return (F.unix_date(value) - F.unix_date(origin)).cast("double")
    if isinstance(value_type, T.TimestampType):
        return (F.unix_micros(value) - F.unix_micros(origin)).cast("double")
    if isinstance(value_type, (T.IntegralType, T.BooleanType)):
        return (value.cast("decimal(20,0)") - origin.cast("decimal(20,0)")).cast("double")
    if isinstance(value_type, T.NumericType):
        return value.cast("double") - origin.cast("double")
    raise TypeError(f"no order statistics for {value_type.simpleString()}")


def _text_number(value: Column) -> Column:
    """The six bytes behind those that all texts of the interval begin with, as a number; shorter texts count as ending in zeros."""
    digits = F.hex(F.substring(value.cast("binary"), F.col("skip_bytes") + 1, F.lit(6)))
    return F.conv(F.rpad(digits, 12, "0"), 16, 10).cast("double")


def values_at_ranks(
    df: DataFrame, column: str, ranks: Sequence[int], bins: int = BINS, count_up_to: int = COUNT_VALUES_UP_TO
) -> list:
    """The values at 0-based ranks of a column in ascending order, missing values left out."""
    if not ranks:
        return []
    _distance(F.lit(0), F.lit(0), df.schema[column].dataType)  # types without an order are refused at any size
    cells = df.select(F.lit(column).alias("column"), F.lit(0).alias("part"), col(column).alias("value")).where(
        "value is not null"
    )
    found = _select(cells, _spans(cells), [(column, _NO_PART, r) for r in ranks], bins, count_up_to)
    return [found[(column, _NO_PART, r)] for r in ranks]


def medians(
    df: DataFrame,
    columns: Sequence[str],
    leave_out: str | None = None,
    bins: int = BINS,
    count_up_to: int = COUNT_VALUES_UP_TO,
    buffer_up_to: int = BUFFER_VALUES_UP_TO,
) -> dict[int | None, dict[str, float | None]]:
    """Exact medians; with an even count the mean of the two middle values.

    ``leave_out`` names a column of small non-negative integers (folds): then there is one set
    of medians per fold, over the rows of all *other* folds, from the same pass over the table.
    Without it the only key of the result is None.
    """
    columns = list(columns)
    if not columns:
        return {}
    part = F.col(leave_out).cast("int") if leave_out else F.lit(0)
    cells = long_form(df.withColumn("part", part), columns, ["part"], cast="double").where(
        "value is not null and not isnan(value)"
    )
    span = _spans(cells)
    counts = {c: span[c]["parts"] if c in span else {} for c in columns}
    skips = sorted({p for c in counts.values() for p in c}) if leave_out else [_NO_PART]
    result: dict[int | None, dict[str, float | None]] = {
        (skip if leave_out else None): dict.fromkeys(columns) for skip in skips
    }
    few = [c for c in span if span[c]["levels"] <= buffer_up_to]
    if few:
        # counted by value and part first: what is aggregated per fold are distinct values, not rows
        by_value = cells.where(F.col("column").isin(few)).groupBy("column", "part", "value").agg(F.count(F.lit(1)).alias("n"))
        if leave_out:
            skip = F.explode(F.array(*[F.lit(s) for s in skips]))
            by_value = by_value.withColumn("skip", skip).where("skip <> part")
        else:
            by_value = by_value.withColumn("skip", F.lit(_NO_PART))
        # one row per column and fold
        for r in by_value.groupBy("column", "skip").agg(F.expr("percentile(value, 0.5, n)").alias("median")).collect():
            result[r["skip"] if leave_out else None][r["column"]] = r["median"]
    many = [c for c in span if c not in few]
    middle = {}
    for c in many:
        for skip in skips:
            n = sum(m for p, m in counts[c].items() if p != skip)
            if n:
                middle[(c, skip)] = sorted({(n - 1) // 2, n // 2})
    wanted = [(c, skip, rank) for (c, skip), ranks in middle.items() for rank in ranks]
    found = _select(cells, span, wanted, bins, count_up_to) if wanted else {}
    for (c, skip), ranks in middle.items():
        values = [found[(c, skip, rank)] for rank in ranks]
        result[skip if leave_out else None][c] = sum(values) / len(values)
    return result
