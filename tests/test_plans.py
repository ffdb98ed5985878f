"""Physical-plan shape of the scale-relevant operators."""

from pyspark.sql import functions as F

from snapstar.operators.asof import as_of_join
from snapstar.operators.dedup import latest_per_key
from snapstar.operators.scd2 import versions_from_snapshots
from snapstar.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_is_a_combining_aggregate_not_a_window(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    plan = _plan(latest_per_key(ev, ["user_id"], "ts", ["event_id"]))
    assert "Window" not in plan
    assert "partial_max" in plan  # map-side combine before the shuffle


def test_sorted_as_of_join_partitions_facts_by_key_and_bucket(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    v = versions_from_snapshots(ev.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"),
                                ["user_id"], ["event_type"], "ts").select("user_id", "version_key", "effective_from", "effective_to")
    plan = _plan(as_of_join(ev.select("event_id", "user_id", "ts"), v, ["user_id"], "ts", strategy="sorted"))
    assert "hashpartitioning(user_id" in plan and "_b#" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_valid_rows_filter_reaches_the_scan(spark):
    plan = _plan(C.quality_valid(spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan or "IsNotNull(l_quantity)" in plan.split("PushedFilters")[1]


def test_latest_snapshot_uses_a_scalar_subquery(spark):
    plan = _plan(C.latest_snapshot_rows(spark, SF))
    assert "Subquery" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(C.weighted_avg(spark, SF))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_shipdate" not in schema and "l_comment" not in schema and "l_quantity" in schema
