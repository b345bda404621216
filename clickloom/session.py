"""Session construction and the one setting every result depends on (UTC)."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# What the jobs rely on.  Sizes (executors, memory, shuffle partitions) belong to
# spark-submit and are left alone here.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Distinct lists are gathered per session; the default of 128 groups per task
    # sends every task to the sort-based path at once.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    **STATE_STORE,
}


def build_session(app: str = "clickloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day, hour and minute keys are cut from timestamps, so the zone is fixed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def off_heap_state(spark: SparkSession) -> None:
    """Running counts live in the state store: keep them off the heap."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
