"""One-hot encoding with any number of levels: a stored table of level and slot, rows as sparse vectors.

``encode.one_hot`` makes a column for each level, which is what a table with few of them wants. Here the levels stay a distributed table: they are numbered in
blocks of their order, and only the hottest become literals of the plan. Rows with another level look it up by a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.functions.checks import col
from tabmill.operators.encode import fill_category
from tabmill.session import materialize

# Levels of all columns that the plan holds as literals.
HOTTEST = 1_000
# Values that rows outside the look-up are dealt to, so that they fill no partition of the join.
_SPREAD = 4_096


def slot_table(level_table: DataFrame, columns: Sequence[str], blocks: int | None = None) -> DataFrame:
    """column, value, n, kept, slot — every level with its slot; the rare levels of a column share its last one. Stored.

    Slots count from 0 without gaps: columns as named, in each its kept levels in the order of their text, then the rare ones.
    ``level_table`` is what ``encode.levels`` gives. The levels are sorted in ``blocks`` ranges, each numbered by itself from where the one before it ends.
    """
    spark = level_table.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.lit(-1)
    for i, c in enumerate(columns):
        place = F.when(F.col("column") == c, i).otherwise(place)
    known = level_table.where(F.col("column").isin(list(columns))).withColumn("_place", place)
    kept = known.where("kept").select("_place", F.lit(0).alias("_rare"), "value")
    # one row per column at most
    rare = known.where("not kept").select("_place", F.lit(1).alias("_rare"), F.lit("").alias("value")).distinct()
    order = ["_place", "_rare", "value"]
    # stored, for the ranges are drawn anew whenever they are computed
    dealt = materialize(kept.unionByName(rare).repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id()), "level-blocks")
    # one row per block
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_block").agg(F.count(F.lit(1)).alias("_size")).select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    numbered = dealt.join(F.broadcast(starts), "_block").withColumn("slot", (F.col("_start") + within - 1).cast("int"))
    shared = numbered.where("_rare = 1").select("_place", F.col("slot").alias("_shared"))
    own = numbered.where("_rare = 0").select(F.col("_place").alias("_at"), F.col("value").alias("_value"), "slot")
    found = (
        known.join(own, (F.col("_place") == F.col("_at")) & (F.col("value") == F.col("_value")) & F.col("kept"), "left")
        .join(F.broadcast(shared), "_place", "left")  # one row per column
        .select("column", "value", "n", "kept", F.coalesce("slot", "_shared").alias("slot"))
    )
    return materialize(found, "level-slots")


def slot_count(slots: DataFrame) -> int:
    """How many slots a table of them has."""
    return slots.agg(F.coalesce(F.max("slot") + 1, F.lit(0)).alias("n")).first()["n"]


def slot_lists(
    df: DataFrame, slots: DataFrame, columns: Sequence[str], hottest: int = HOTTEST, name: str = "slots", spread_by: Sequence[str] = ()
) -> DataFrame:
    """The table with the slots of each row as an ascending array instead of the columns; levels not seen in fitting have none.

    ``spread_by`` names columns, such as the key, that spread the rows which look nothing up over the join; without any, the encoded columns do.
    """
    hot = slots.orderBy(F.desc("n"), "column", "value").limit(hottest).select("column", "value", "slot").collect()
    # of the content, so that a task that is made again deals its rows alike
    spread = F.pmod(F.xxhash64(*[col(c) for c in spread_by or columns]), F.lit(_SPREAD)).cast("string")
    out = fill_category(df.withColumn("_spread", spread), columns)
    for i, c in enumerate(columns):
        pairs = [F.lit(x) for r in hot if r["column"] == c for x in (r["value"], r["slot"])]
        at = F.try_element_at(F.create_map(*pairs), col(c)) if pairs else F.lit(None).cast("int")
        cold = slots.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("slot").alias("_slot"), F.lit(True).alias("_looked_up"))
        # a row with a hot level finds nothing; its key only spreads it
        out = out.withColumn(f"_at{i}", at).withColumn("_cold", F.col(f"_at{i}").isNull())
        out = out.withColumn("_probe", F.when(F.col("_cold"), col(c)).otherwise(F.col("_spread")))
        out = out.join(cold, (F.col("_probe") == F.col("_value")) & (F.col("_cold") == F.col("_looked_up")), "left")
        out = out.withColumn(f"_at{i}", F.coalesce(f"_at{i}", "_slot")).drop("_cold", "_probe", "_value", "_slot", "_looked_up")
    found = [f"_at{i}" for i in range(len(columns))]
    listed = F.array_sort(F.array_compact(F.array(*found))) if found else F.array().cast("array<int>")
    return out.withColumn(name, listed).drop("_spread", *found, *[c for c in columns if c != name])


def one_hot_vectors(
    df: DataFrame, slots: DataFrame, columns: Sequence[str], hottest: int = HOTTEST, name: str = "features", spread_by: Sequence[str] = ()
) -> DataFrame:
    """As ``slot_lists``, with a sparse vector of ones as long as the table of slots: what a learner takes."""
    listed = slot_lists(df, slots, columns, hottest, name, spread_by)
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(slot_count(slots)).alias("size"), col(name).alias("indices"),
        F.transform(col(name), lambda _: F.lit(1.0)).alias("values"),
    )
    # a vector is stored as such a struct; reading the struct's text by the vector's type is how SQL makes one
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return listed.withColumn(name, F.from_json(F.to_json(F.struct(vector.alias("v"))), schema)["v"])
