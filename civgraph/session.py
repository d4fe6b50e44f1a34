"""Session construction."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job of the pipeline relies on.  They are set on our own
# sessions; when a caller owns the session, ``ensure_pipeline_conf`` applies
# the runtime-settable ones.
RUNTIME_CONF = {
    # AQE: coalesce small shuffle partitions, split skewed join partitions,
    # convert sort-merge joins to broadcast when the runtime size allows it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Some regional sources are published in windows-1252; Spark 4 only
    # accepts that charset name for CSV/decode with the legacy switch.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(app: str = "civgraph", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    conf["spark.ui.enabled"] = "false"
    # the pipeline submits independent jobs from a few threads; FAIR lets a
    # small job run beside a large one instead of queueing behind it
    conf["spark.scheduler.mode"] = "FAIR"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.session.timeZone"] = "UTC"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_pipeline_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # read-only on some managed sessions
            pass
