"""Plan properties the scale design relies on, checked on the physical plans."""

import pytest

from tidemark.plans.queries import queries
from conftest import SF_SMALL

# Streams run when they are called and give a scan of what they wrote: no plan to look at.
PLANNED = sorted(n for n in queries() if not n.startswith("stream_"))
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_batch_plans_stay_on_the_jvm(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_keyword_count_is_combined_before_the_shuffle(spark):
    plan = _plan(queries()["keyword_window"](spark, SF_SMALL))
    assert "partial_count" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(queries()["fn_to_date"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    plan = _plan(queries()["dic_lookup"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_documents_never_broadcast(spark):
    plan = _plan(queries()["keyword_window"](spark, SF_SMALL))
    for part in plan.split("BroadcastExchange")[1:]:
        head = part.split("Exchange")[0]
        assert "documents" not in head


def test_bounce_window_partitions_by_device_and_bucket(spark):
    plan = _plan(queries()["user_jump"](spark, SF_SMALL))
    assert "hashpartitioning(mid" in plan and "_bucket" in plan


@pytest.mark.parametrize("name", PLANNED)
def test_no_data_funnels_into_one_task(spark, name):
    """A single-partition exchange may only feed a global aggregate whose partial
    step (one row per task, ``keys=[]``) lies right under it: never rows, never a global
    sort. The table of block maxima (one row per block of rows) is the one exception."""
    lines = _plan(queries()[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i + 1:i + 3])
            if "_top" in below and "keys=[_block" in below:
                continue
            assert "keys=[], functions=[partial_" in below, (name, below[:200])


def test_flag_repair_anchor_is_a_hash_aggregate(spark):
    plan = _plan(queries()["visitor_flag_repair"](spark, SF_SMALL))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_split_queries_build_their_route_only(spark):
    from tidemark.operators.split import TOPIC_ERR, TOPIC_PAGE
    plan = queries()["split_err"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert TOPIC_ERR in plan and TOPIC_PAGE not in plan
