"""Shape of the physical plans, with broadcasting by size switched off as on large tables."""

import re

import pytest

from conftest import SF
from vintora.registry.catalog import ALL

PLANS = ["m03_route_scd", "m04_grouped_orders", "m05_loss_rates", "m06_par_snapshot",
         "m07_vintage_analysis", "m08_customer_grid", "m09_kpis_daily", "m13_customer_sales_history",
         "m16_lifecycle_audience", "m17_matured_loans_profile", "m18_pre_post_sales",
         "m19_woe_table", "m21_pair_odds", "m23_contest_base", "d09_roll_rates", "fallback_join",
         "scd_join", "x13_compare_lines", "reach_share"]


@pytest.fixture
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(spark, name):
    df = ALL[name].run(spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANS)
def test_no_nested_loops_and_no_python(spark, no_small_tables, name):
    assert not re.findall("NestedLoop|Cartesian|Python|ArrowEval", plan(spark, name))


def test_scans_are_pruned_and_filtered(spark):
    text = ALL["collapse_lines"].run(spark, SF)._jdf.queryExecution().toString()
    lineitem = re.search(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(c.split(":")[0] for c in lineitem.split(",")) == {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"}
    assert "1997" not in text


def test_unused_sides_of_the_grid_are_dropped(spark, no_small_tables):
    """The distance table reads no orders although the grid joins them."""
    text = plan(spark, "f16_distance")
    assert "lineitem.parquet" not in text


# Shuffles of the final plan, with merge joins only: at most half of what the whole order book took.
MOST = {"d09_roll_rates": 20, "d10_charge_off": 20, "m19_woe_table": 30, "x15_recovery_curve": 16}


@pytest.mark.parametrize("name", sorted(MOST))
def test_narrow_loans_shuffle_less(spark, no_small_tables, name):
    df = ALL[name].run(spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall("ShuffleQueryStage", final)) <= MOST[name]
    # Nothing of the order book is looked up.
    assert "route_days" not in final and "valid_from" not in final


@pytest.mark.parametrize("name", ["m15_seasonality_month", "d10_charge_off"])
def test_distinct_counts_copy_no_rows(spark, name):
    assert "Expand" not in plan(spark, name)
