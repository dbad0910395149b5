"""Spark session with the settings the operators are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Lookup joins repeat hot keys on the row side only; let AQE split those partitions even
    # when the split costs a later shuffle its reuse.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Above this size the JVM does not compile a method; Spark then generates smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(name: str = "snaptrack", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: For the writes of jobs, also in sessions built elsewhere. Shuffle files go with the write they served;
#: otherwise those of all writes stay on disk until the driver happens to collect its garbage.
JOB_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": SETTINGS["spark.sql.codegen.hugeMethodLimit"],
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


# The size of a file says little of its rows in memory: a join is planned as a broadcast only for files so many
# times smaller than the session's threshold, and as soon as the rows themselves are measured to be below it.
SHRUNK = 64
_PLANNED, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def job_settings(spark: SparkSession) -> Iterator[None]:
    """The session has the settings of jobs inside the block, and its own again after it."""
    settings = dict(JOB_SETTINGS)
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        threshold = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        settings[_PLANNED] = str(threshold // SHRUNK if threshold > 0 else threshold)
        settings[_MEASURED] = spark.conf.get(_MEASURED, None) or str(threshold)
    own = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
