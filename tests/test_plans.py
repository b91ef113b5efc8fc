"""What the physical plans must and must not hold."""

import pytest

import __spark_entry__ as contract
from weftwork.operators import scan, similar
from weftwork.plans.registry import table

QUERIES = contract.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "io_"))))
def test_no_pairwise_join_and_no_row_python(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_only_needed_columns_are_read(spark, data):
    text = plan(QUERIES["url_canonical"](spark, data))
    assert "html" not in text
    text = plan(QUERIES["parameter_query"](spark, data))
    assert "PushedFilters" in text and "GreaterThan(o_totalprice,100000.0)" in text


def test_groups_are_limited_before_the_shuffle(spark, data):
    df = scan.first_rows(table(spark, data, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 5)
    text = plan(df)
    assert text.index("WindowGroupLimit") < text.rindex("Exchange") < text.rindex("WindowGroupLimit")


def test_similar_names_meet_by_equality(spark, data):
    parts = table(spark, data, "part").select("p_name").distinct()
    text = plan(similar.candidates(parts, "p_name", parts.withColumnRenamed("p_name", "term"), "term", 0.8))
    assert "_band" in text and "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
