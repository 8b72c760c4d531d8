"""Sinks: staged publish of tables, lineage stamp, JSON manifest, SQLite mirror."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stamp(df: DataFrame, slug: str, origin: str, extracted_at: str) -> DataFrame:
    """Lineage columns; ``data_as_of`` stays null until a source declares it."""
    return df.withColumns(
        {"source_slug": F.lit(slug), "source_origin": F.lit(origin),
            "extracted_at": F.lit(extracted_at).cast("timestamp"), "data_as_of": F.lit(None).cast("timestamp")}
    )


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def stage(df: DataFrame, name: str, warehouse: str, run_id: str) -> DataFrame:
    """Write a table of a run where no reader looks yet, and read it back."""
    path = f"{warehouse.rstrip('/')}/runs/{run_id}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def point(spark: SparkSession, warehouse: str, run_id: str) -> None:
    """Let ``CURRENT`` name the run; from then on its tables are the published ones."""
    fs, p = _fs(spark, f"{warehouse.rstrip('/')}/CURRENT")
    out = fs.create(p, True)
    out.write(bytearray(run_id.encode()))
    out.close()


def publish(tables: Mapping[str, DataFrame], warehouse: str, run_id: str) -> str:
    """Write all tables under ``runs/<run_id>``, then point ``CURRENT`` there.

    A run that fails half way leaves the pointer, and so all readers, on the
    run before.
    """
    for name, df in tables.items():
        stage(df, name, warehouse, run_id)
    if tables:
        point(next(iter(tables.values())).sparkSession, warehouse, run_id)
    return f"{warehouse.rstrip('/')}/runs/{run_id}"


def current(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A table of the run that is published."""
    run = spark.read.text(f"{warehouse.rstrip('/')}/CURRENT").first()[0]
    return spark.read.parquet(f"{warehouse.rstrip('/')}/runs/{run}/{name}")


def write_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def mirror_sqlite(tables: Mapping[str, DataFrame], path: str, most: int = 1_000_000) -> None:
    """Copy small tables into SQLite, timestamps as ISO text; larger ones than ``most`` rows are refused."""
    with sqlite3.connect(path) as db:
        for name, df in tables.items():
            if df.limit(most + 1).count() > most:
                raise ValueError(f"{name} has over {most} rows; the mirror is for small tables")
            times = [f.name for f in df.schema if f.dataType.typeName().startswith(("timestamp", "date"))]
            df.select(*[F.col(c).cast("string").alias(c) if c in times else F.col(c)
                for c in df.columns]).toPandas().to_sql(name, db, if_exists="replace", index=False)


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A summary table as Markdown; a report, so it has a limit."""
    rows = df.limit(most).collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |"
        for r in rows) + "\n"


def manifest(path: str, **what: object) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(what, f, indent=1, default=str)
