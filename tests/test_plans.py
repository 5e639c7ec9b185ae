"""Plan properties the design relies on (checked on the smallest tables)."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from pointlake.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module", autouse=True)
def _tables():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_country_filter_pushed_to_scan(spark):
    plan = _plan(QUERIES["top_products_country"](spark, SF))
    assert "EqualTo(n_name,NATION_7)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double," \
           "l_returnflag:string>" in plan
    assert "TakeOrderedAndProject" in plan


def test_word_count_reads_text_only_and_combines_map_side(spark):
    plan = _plan(QUERIES["word_count"](spark, SF))
    assert "ReadSchema: struct<text:string>" in plan
    assert "partial_count" in plan
    assert plan.count("Arguments: hashpartitioning") == 1  # the one shuffle, on word
    assert "Arguments: hashpartitioning(word" in plan


def test_pairs_dedup_is_keyed_on_product_and_customer(spark):
    plan = _plan(QUERIES["product_popularity"](spark, SF))
    assert "hashpartitioning(product_id" in plan and "customer_id" in plan
    assert "partial_count" in plan


def test_objective_is_a_top_k(spark):
    plan = _plan(QUERIES["kcenter_objective"](spark, SF))
    assert "TakeOrderedAndProject" in plan
    assert not re.search(r"\) Sort\b", plan)  # no full sort anywhere


def test_purchase_filter_reaches_the_scan(spark):
    plan = _plan(QUERIES["top_products"](spark, SF))
    assert "GreaterThanOrEqual(l_quantity,1.0)" in plan


def test_term_frequency_has_no_hash_exchange(spark):
    assert "hashpartitioning" not in _plan(QUERIES["doc_term_freq"](spark, SF))


def test_partition_combine_has_one_exchange(spark):
    plan = _plan(QUERIES["word_count_partitioned"](spark, SF))
    assert plan.count("Arguments: hashpartitioning") == 1 and "partial_sum" in plan and "MapInArrow" in plan


def test_salted_dedup_has_both_rounds(spark):
    plan = _plan(QUERIES["product_customer_pairs_salted"](spark, SF))
    assert "Arguments: hashpartitioning(salt" in plan
    assert "Arguments: hashpartitioning(product_id" in plan
    first, _, rest = plan.partition("Arguments: hashpartitioning(salt")
    assert "HashAggregate" in rest.partition("Arguments: hashpartitioning(product_id")[0]


def test_salted_dedup_deals_to_as_many_tasks_as_the_session_asks_for(spark):
    plan = _plan(QUERIES["product_customer_pairs_salted"](spark, SF))
    assert "REPARTITION_BY_NUM" not in plan
    assert re.search(r"hashpartitioning\(salt#\d+L?, product_id#\d+L?, customer_id#\d+L?, ", plan)


def test_bitmaps_are_merged_by_hash_and_no_larger_than_a_pair(spark):
    plan = _plan(QUERIES["product_popularity_bitmaps"](spark, SF))
    assert "SortAggregate" not in plan and "bitmap_construct_agg" not in plan and "partial_bit_or" in plan


def test_text_lines_are_split_once(spark):
    plan = QUERIES["txn_text_pair_count"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bsplit\(", plan)) == 1 and len(re.findall(r"\bconcat_ws\(", plan)) == 1


def test_traversal_pass_has_no_sort_aggregate_and_no_group_of_a_part(spark, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    to_arrow = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda self: plans.append(_plan(self)) or to_arrow(self))
    QUERIES["coreset_points"](spark, SF)
    assert plans and all("MapInArrow" in p for p in plans)
    assert not any(re.search("SortAggregate|FlatMapGroups", p) for p in plans)


def test_queries_leave_nothing_cached(spark):
    for name in ("ball_weights", "heaviest_ball", "ball_removal", "greedy_cover", "greedy_cover_uncovered",
                 "kcenter_report", "nearest_center"):
        QUERIES[name](spark, SF).collect()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0, name
