"""Session set-up for jobs and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tallyward", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Only the time zone and the adaptive rules are set here: hot partitions of a join
    are split also where that costs another shuffle. Sizes, shuffle partitions and
    ``spark.checkpoint.dir`` belong to the cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
