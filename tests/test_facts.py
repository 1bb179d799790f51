"""Stored order facts and refined percentiles against the direct forms."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide.functions.refined import refined_quantiles
from ordertide.operators import facts, orders
from ordertide.plans.registry import Tables
from ordertide.schemas import ORDER_EVENTS


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_refined_quantiles_equal_numpy(spark, bins):
    rng = random.Random(bins)
    groups = {"wide": [rng.randrange(-(10**9), 10**9) for _ in range(301)], "one": [5], "same": [7] * 40, "two": [-1, 2], None: [1, 2, 4]}
    rows = [(g, v, rng.randint(1, 3)) for g, values in groups.items() for v in values] + [("wide", None, 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "g string, v long, w int")
    if bins == 2:
        df = df.filter(F.abs("v") < 1000)  # few rounds
    got = {r.g: r for r in refined_quantiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}, "w", bins).collect()}
    expanded = {}
    for g, v, w in rows:
        if v is not None and (bins > 2 or abs(v) < 1000):
            expanded.setdefault(g, []).extend([v] * w)
    assert set(got) == set(expanded)
    for g, values in expanded.items():
        assert got[g].n == len(values)
        assert np.allclose([got[g].p50, got[g].p95], np.quantile(values, [0.5, 0.95]))
    everything = refined_quantiles(df, [], "v", {"p50": 0.5}, "w", bins).collect()
    assert np.isclose(everything[0].p50, np.quantile(sum(expanded.values(), []), 0.5))
    assert refined_quantiles(df.filter("v IS NULL"), ["g"], "v", {"p50": 0.5}).count() == 0


def _cut(frame, day):
    late = F.coalesce(F.col("event_time") >= F.lit(day), F.lit(True))
    return frame.filter(~late), frame.filter(late)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    feed = Tables(spark, "/root/testdata/sf0.001").orders
    odd = feed.limit(30).withColumns({"order_id": F.lit(None).cast("string")})
    feed = feed.unionByName(odd).unionByName(feed.filter("event_type = 'order_created'").limit(50))
    old, new = _cut(feed, datetime.datetime(2024, 1, 20))
    path = str(tmp_path_factory.mktemp("facts"))
    first = facts.save_facts(facts.order_facts(old), "facts_test_old", f"{path}/old", 4)
    both = facts.merge_facts(first, facts.order_facts(new))
    return feed, facts.save_facts(both, "facts_test_all", f"{path}/all", 4)


def test_old_facts_and_a_new_part_equal_all_events(stored):
    feed, table = stored
    assert sorted(map(repr, table.collect())) == sorted(map(repr, facts.order_facts(feed).select(table.columns).collect()))
    got, want = facts.order_kpis(table).collect(), orders.order_kpis(feed).collect()
    assert np.allclose([float(v) for v in got[0]], [float(v) for v in want[0]]) and got[0].asDict().keys() == want[0].asDict().keys()
    got, want = facts.stage_times(table).collect(), orders.stage_times(feed).collect()
    assert sorted((r.stage_no, r.stage, round(r.avg_min, 9)) for r in got) == sorted((r.stage_no, r.stage, round(r.avg_min, 9)) for r in want)
    got, want = facts.at_risk_orders(table).collect(), orders.at_risk_orders(feed.filter("order_id IS NOT NULL")).collect()
    assert got and sorted(map(repr, got)) == sorted(map(repr, want))


def test_per_order_work_on_stored_facts_moves_nothing(spark, stored):
    _, table = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = facts._pairs(table, "order_created", "order_delivered", "user_zone_id")
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    per_order = table.groupBy("order_id").agg(F.max("event_time"))
    assert "Exchange" not in per_order._jdf.queryExecution().executedPlan().toString()


def test_no_facts(spark):
    none = facts.order_facts(spark.createDataFrame([], ORDER_EVENTS))
    row = facts.order_kpis(none).collect()[0]
    assert row.total_created == 0 and row.p95_delivery_min is None and row.cancellation_rate_pct == 0
    assert facts.at_risk_orders(none).count() == 0 and facts.stage_times(none).count() == 0
