"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that ``[\x20\x09-\x0D]`` names.
BLANKS = " \t\n\x0b\x0c\r"
#: A word: a run of anything but those.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Folders made for applications in local mode.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only in local mode, as in tests, a folder is made where it is unset; on a
    cluster that is an error, as no machine's own folder is shared.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.conf.get("spark.app.id")
        where = _LOCAL[app] = _LOCAL.get(app) or tempfile.mkdtemp(prefix="harborline-")
    return where.rstrip("/")


#: Rows of a batch that goes to Python: Spark's 10,000 texts would be tens of MB, on both sides.
TEXTS = 1000
#: Bytes of a join's smaller side in a partition that adaptive execution may hash instead of sort.
HASHED = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Settings that the operators on texts need, where the session leaves them unset."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS),
        ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


#: Where each settled frame lies.
_SETTLED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: Spark then deletes the shuffle files of a write when the write has ended.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/settled/{spark.conf.get('spark.app.id')}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts lineage; the copy survives the loss of any executor, and the shuffle
    files that made it can go.
    """
    spark = df.sparkSession
    path = f"{_home(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
    out = spark.read.schema(df.schema).parquet(path)
    _SETTLED[out] = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(*frames: DataFrame) -> None:
    """Delete settled frames that nothing reads any more."""
    for df in frames:
        if path := _SETTLED.pop(df, None):
            _delete(df.sparkSession, path)


def clean_up(spark: SparkSession) -> None:
    """Delete all that this application has settled; call it when its results are written."""
    _delete(spark, _home(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame):
    """All columns of ``df`` in one struct, so that no helper column can clash."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def wide_hash(*cols):
    """Two independently seeded 64-bit hashes of the columns: 128 bits together."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(7), *cols)


def ascii_lower(text):
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
