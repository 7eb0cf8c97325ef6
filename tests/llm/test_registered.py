"""Queries against DuckDB where SQL can express them; plans of the native ones; the entry point without the subpackage."""

import re

import pytest

from tabmill.llm.queries import QUERIES, SQL
from workload.check import compare

NATIVE = ["op1_chat_formatting", "op7_quality_rules", "op8_sharding"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, sf, name):
    outcome = compare(spark, sf, name, QUERIES[name], SQL[name])
    assert outcome.startswith("equal"), outcome


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_hold_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|LogicalRDD", plan)


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in entry.queries()) if m)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()
