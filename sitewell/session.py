"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Spark measures every join side itself: below the threshold it broadcasts, above it shuffles,
# and the adaptive planner corrects both at run time and splits skewed partitions. The library
# therefore carries no broadcast hints.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files go when the frame that needs them does
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # plans here are built from many small expressions; recording a call site for each doubles that time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "sitewell", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointing(spark: SparkSession) -> SparkSession:
    """Checkpoints go where the cluster says (spark.checkpoint.dir). Where that is not set, as in tests,
    they go beside the tables, in the warehouse. On a cluster that must be a store all executors share:
    a folder of the driver's own disk fails here instead of losing blocks later."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named, warehouse = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not named and not context.master.startswith("local") and (warehouse.startswith("file:") or ":" not in warehouse):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or f"{warehouse}/_checkpoints")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else the context's own."""
    return spark.conf.get("spark.checkpoint.dir", None) or checkpointing(spark).sparkContext._jsc.sc().getCheckpointDir().get()
