"""Tables replaced by a version pointer."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tabmill.sources import sinks


@pytest.fixture(scope="module")
def space(spark):
    sinks.ensure_namespace(spark, "versioned")
    return "versioned"


def values(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


@pytest.mark.parametrize("below", [True, False])
def test_replaced_with_another_schema_and_from_itself(spark, space, tmp_path, below):
    name = f"{space}.t{int(below)}"
    path = str(tmp_path / "t") if below else None
    assert sinks.overwrite_table(spark.range(3), name, path=path) == 3
    assert sinks.overwrite_table(spark.table(name).select((F.col("id") + 1).alias("n"), F.lit("x").alias("s")), name, path=path) == 3
    assert values(spark, name) == [(1, "x"), (2, "x"), (3, "x")]
    assert sinks.overwrite_table(spark.table(name).where("n > 2"), name, path=path) == 1
    assert values(spark, name) == [(3, "x")]
    assert [sinks._number(v) for v in sinks.table_versions(spark, name)] == [2, 3]  # the latest and the one before
    if below:
        assert len(list(Path(path).iterdir())) == 2


def test_versions_go_beyond_nine_and_others_are_left_alone(spark, space):
    name = f"{space}.many"
    sinks.overwrite_table(spark.range(1), f"{name}__v", keep=0)
    sinks.overwrite_table(spark.range(1), f"{name}_more", keep=0)
    for n in range(12):
        sinks.overwrite_table(spark.range(n, n + 1), name, keep=2)
    assert values(spark, name) == [(11,)]
    assert [sinks._number(v) for v in sinks.table_versions(spark, name)] == [10, 11, 12]
    assert values(spark, f"{name}__v") == values(spark, f"{name}_more") == [(0,)]


def test_a_reader_that_has_begun_ends_with_the_old_rows(spark, space, tmp_path):
    name = f"{space}.begun"
    sinks.overwrite_table(spark.range(5), name, path=str(tmp_path / "b"))
    begun = spark.table(name)
    begun.count()
    sinks.overwrite_table(spark.range(2), name, path=str(tmp_path / "b"))
    assert begun.count() == 5 and spark.table(name).count() == 2


def test_a_failed_write_leaves_the_old_version(spark, space, tmp_path):
    name = f"{space}.failing"
    sinks.overwrite_table(spark.range(4), name, path=str(tmp_path / "f"))
    with pytest.raises(Exception, match="no rows today"):
        sinks.overwrite_table(spark.range(4).select(F.raise_error(F.lit("no rows today")).cast("int").alias("id")), name, path=str(tmp_path / "f"))
    assert spark.table(name).count() == 4 and len(sinks.table_versions(spark, name)) == 1
    assert sinks.overwrite_table(spark.range(1), name, path=str(tmp_path / "f")) == 1


def test_a_plain_table_becomes_a_version(spark, space):
    name = f"{space}.plain"
    spark.range(7).write.saveAsTable(name)
    sinks.overwrite_table(spark.table(name).where("id < 2"), name)
    assert spark.table(name).count() == 2
    assert [sinks._number(v) for v in sinks.table_versions(spark, name)] == [0, 1]


def test_a_reader_in_a_loop_never_misses_the_table(spark, space, tmp_path):
    name = f"{space}.looped"
    sinks.overwrite_table(spark.range(10), name, path=str(tmp_path / "l"), keep=9)
    stop, seen, failed = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).agg(F.count("*"), F.max("id")).first()[:])
            except Exception as error:  # noqa: BLE001 - whatever a reader meets counts
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(8):
        sinks.overwrite_table(spark.range(20 + n), name, path=str(tmp_path / "l"), keep=9)
    stop.set()
    reader.join()
    assert not failed
    # whole versions only
    assert len(seen) > 1 and all(most == count - 1 for count, most in seen)
