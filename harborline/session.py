"""The session that the library expects: UTC, ANSI, adaptive execution."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "harborline", master: str | None = None, **conf: str) -> SparkSession:
    """A session; ``conf`` keys use ``__`` for dots. A cluster's own settings win where set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share, its lineage cut.

    The folder is ``spark.checkpoint.dir`` of the session. Where that is unset,
    local mode makes one; a cluster is an error, as no machine's own folder is shared.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            where = tempfile.mkdtemp(prefix="harborline-checkpoints-")
        context.setCheckpointDir(where)
    return df.checkpoint()


@contextmanager
def fixed_layout(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Plans made inside shuffle to ``tasks`` and don't change while they run, so checkpoints keep how rows are dealt and sorted.

    Of an adaptive plan Spark doesn't know that before it has run, and shuffles
    its checkpoint again in each join.
    """
    fixed = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(tasks)}
    was = {k: spark.conf.get(k) for k in fixed}
    try:
        for k, v in fixed.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
