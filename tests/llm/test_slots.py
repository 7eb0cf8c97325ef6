"""Sharding: near-equal bytes, gapless positions, maps that are edited."""

import zlib

import pytest
from pyspark.sql import functions as F

from tabmill.llm import slots

SCHEMA = "doc_id long, text string, shard string"


def placed(spark, tmp_path, rows, n_shards=7, n_slots=slots.N_SLOTS):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return slots.shard_documents(docs, n_shards, str(tmp_path / "map"), n_slots).collect()


def check_positions(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sizes_checksums_and_balance(spark, tmp_path):
    docs = [(i, "é" * (i * 37 % 211), "x") for i in range(1500)]
    rows = placed(spark, tmp_path, docs)
    texts = {i: t.encode() for i, t, _ in docs}
    assert len(rows) == 1500
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
    loads = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(7)]
    assert max(loads) - min(loads) <= max(r["size"] for r in rows)
    check_positions(rows)


def test_largest_first_as_a_plain_loop_does_it(spark, tmp_path):
    docs = [(i, "a" * (i * i % 997), "x") for i in range(300)]
    df = spark.createDataFrame(docs, SCHEMA)
    loads = slots.slot_loads(slots.records(df, n_slots=64))
    sizes = {r["virtual_slot"]: r["bytes"] for r in loads.collect()}
    held, want = [0] * 5, {}
    for slot, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        least = held.index(min(held))
        held[least] += size
        want[slot] = least
    assert {r["virtual_slot"]: r["shard"] for r in slots.first_map(loads, 5).collect()} == want


def test_a_new_shard_takes_slots_and_nothing_else_moves(spark, tmp_path):
    docs = [(i, "a" * (i * 31 % 401), "x") for i in range(4000)]
    loads = slots.slot_loads(slots.records(spark.createDataFrame(docs, SCHEMA), n_slots=512))
    path = str(tmp_path / "map")
    slots.store_map(slots.first_map(loads, 8), path)
    slots.store_map(slots.grown_map(slots.read_map(spark, path, 1), 8), path)
    before = {r["virtual_slot"]: r for r in slots.read_map(spark, path, 1).collect()}
    after = {r["virtual_slot"]: r for r in slots.read_map(spark, path).collect()}
    assert set(before) == set(after) and {r["version"] for r in after.values()} == {2}
    assert all(after[s]["shard"] in (8, before[s]["shard"]) for s in after)
    held = [sum(r["bytes"] for r in after.values() if r["shard"] == s) for s in range(9)]
    assert max(held) - min(held) <= 2 * max(r["bytes"] for r in after.values())


def test_a_third_of_the_rows_alike_nulls_and_clashing_names(spark, tmp_path):
    docs = [(1, "same", "x")] * 500 + [(None, None, "y")] * 500 + [(i, f"t{i}", None) for i in range(500)]
    rows = placed(spark, tmp_path, docs)
    assert len(rows) == 1500
    assert sum(r["size"] == 16 and r["text_crc32"] == 0 for r in rows) == 500
    check_positions(rows)
    assert len({r["virtual_slot"] for r in rows if r["doc_id"] == 1 and r["size"] == 20}) <= 2


def test_rows_of_a_slot_are_numbered_in_parts(spark, tmp_path):
    rows = placed(spark, tmp_path, [(i, "a", "x") for i in range(200)], n_shards=2, n_slots=3)
    check_positions(rows)


@pytest.mark.parametrize("n_shards", [1, 40])
def test_empty_table(spark, tmp_path, n_shards):
    assert placed(spark, tmp_path, [], n_shards) == []


def test_slot_does_not_depend_on_layout(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.lit("x").alias("shard"))
    one, many = (slots.records(df.repartition(n)).select("doc_id", "virtual_slot") for n in (1, 9))
    assert one.exceptAll(many).isEmpty()


def test_the_eleventh_version_is_the_latest(spark, tmp_path):
    loads = spark.createDataFrame([(i, 10 * i + 1, 1) for i in range(64)], "virtual_slot int, bytes long, n_rows long")
    path = str(tmp_path / "map")
    for version in range(1, 12):
        slots.store_map(slots.first_map(loads, 1 + version % 3, version), path)
    latest = slots.read_map(spark, path)
    assert {r["version"] for r in latest.collect()} == {11} and latest.schema["version"].dataType.typeName() == "integer"
    assert {r["shard"] for r in latest.collect()} == {0, 1, 2}
    assert {r["version"] for r in slots.read_map(spark, path, 9).collect()} == {9}


def plain_moves(held, sizes, n_shards, most):
    """The same moves by a plain loop."""
    load = [sum(sizes[s] for s in held if held[s] == n) for n in range(n_shards)]
    for _ in range(most):
        full, empty = load.index(max(load)), load.index(min(load))
        gap = max(load) - min(load)
        gains = [(abs(2 * sizes[s] - gap), s) for s in sorted(held) if held[s] == full and 0 < sizes[s] < gap]
        if not gains:
            break
        slot = min(gains)[1]
        held[slot] = empty
        load[full] -= sizes[slot]
        load[empty] += sizes[slot]
    return held, load


@pytest.mark.parametrize("most", [0, 3, 100])
def test_rebalancing_moves_slots_from_the_fullest_to_the_emptiest(spark, most):
    sizes = {i: (i * i * 37) % 501 for i in range(60)}
    sizes[60] = 9000  # more than a shard's share
    before = spark.createDataFrame([(4, i, i % 5, 1) for i in range(58)], "version int, virtual_slot int, shard int, bytes long")
    loads = spark.createDataFrame([(i, b, 1) for i, b in sizes.items()], "virtual_slot int, bytes long, n_rows long")
    got = slots.rebalanced_map(before, loads, 5, most or 1).collect()
    want, load = plain_moves({i: i % 5 for i in range(61)}, sizes, 5, most or 1)
    assert {r["virtual_slot"]: r["shard"] for r in got} == want
    assert {r["version"] for r in got} == {5} and {r["virtual_slot"]: r["bytes"] for r in got} == sizes


def test_rows_are_placed_by_the_latest_version(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a" * (i * 31 % 401), "x") for i in range(900)], SCHEMA)
    path = str(tmp_path / "map")
    first = slots.shard_documents(docs, 4, path, 64).collect()
    assert {r["version"] for r in first} == {2}
    grown = docs.union(spark.createDataFrame([(i, "b" * 5000, "x") for i in range(900, 905)], SCHEMA))
    second = slots.shard_documents(grown, 4, path, 64).collect()
    assert {r["version"] for r in second} == {3} and len(second) == 905
    held = {r["virtual_slot"]: r["shard"] for r in slots.read_map(spark, path).collect()}
    assert all(held[r["virtual_slot"]] == r["shard"] for r in second)
    check_positions(second)
