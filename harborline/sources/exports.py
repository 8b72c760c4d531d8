"""Typed read of CSV exports under a contract, with a report of what was lost."""

from __future__ import annotations

import csv
import os
import re
import shutil
import urllib.request
from dataclasses import dataclass, field
from urllib.parse import urlsplit, urlunsplit

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numbers
from ..functions.dates import parse_date
from ..functions.text import named, strip_all
from .contracts import Contract

ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
#: What the bytes 0x80 to 0x9F mean in Latin-1 (control characters) and in Windows-1252.
_CONTROLS = tuple("".join(chr(b) if e == "latin-1" else bytes([b]).decode(e) for b in range(0x80, 0xA0) if bytes([b])
    .decode("cp1252", "ignore")) for e in ("latin-1", "cp1252"))


class MissingColumns(ValueError):
    """The export lacks columns that its contract declares."""


@dataclass
class Export:
    frame: DataFrame
    raw: DataFrame
    unexpected: list[str] = field(default_factory=list)

    def _lost(self) -> dict[str, Column]:
        """For each typed column, how many non-null cells no longer hold a value."""
        typed = [f.name for f in self.frame.schema if not isinstance(f.dataType, T.StringType)
            and f"_raw_{f.name}" in self.raw.columns]
        return {c: F.count_if(named(f"_raw_{c}").isNotNull() & named(c).isNull()) for c in typed}

    def coercion_report(self) -> DataFrame:
        """(column, lost): non-null cells that no longer hold a value, where there are any."""
        spark, lost = self.raw.sparkSession, self._lost()
        if not lost:
            return spark.createDataFrame([], "column string, lost bigint")
        sums = self.raw.agg(F.array(*[F.struct(F.lit(c).alias("column"), n.alias("lost")) for c, n in lost.items()])
            .alias("rows"))
        return sums.select(F.explode("rows").alias("r")).select("r.*").where("lost > 0")

    def observed(self) -> tuple[DataFrame, Observation | None]:
        """The typed rows, which count what they lose while they are read, and where the counts will be."""
        lost = self._lost()
        if not lost:
            return self.frame, None
        counts = Observation()
        seen = self.raw.observe(counts, *[n.alias(c) for c, n in lost.items()])
        return seen.select(*map(named, self.frame.columns)), counts


def sniff_encoding(data: bytes) -> str:
    """The first encoding that decodes all of the bytes."""
    for e in ENCODINGS:
        try:
            data.decode(e)
            return e
        except UnicodeDecodeError:
            continue
    return "latin-1"


def layout(spark: SparkSession, path: str) -> tuple[str, bool]:
    """(encoding, whether a quoted value may hold a line break), told from every line of the file.

    One pass over lines, which split between tasks: a file is UTF-8 if all its
    lines are, else Windows-1252 unless a byte has no meaning there. A quote
    that is open at a line's end leaves an odd number of quotes on the line.
    """
    line = F.col("value")
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    undefined = F.hex(line.cast("binary")).rlike("^(?:[0-9A-F]{2})*?(?:81|8D|8F|90|9D)")
    good = F.is_valid_utf8(line)
    told = spark.read.text(path).agg(F.count_if(~good).alias("other"), F.count_if(~good & undefined).alias("odd"),
        F.count_if(quotes % 2 == 1).alias("open")).first()
    e = "utf-8" if not told["other"] else "cp1252" if not told["odd"] else "latin-1"
    return e, told["open"] > 0


def typed(c, dtype: str):
    """Text to a contract's type; what doesn't parse is null. Trimmed first; empty is null."""
    t = F.nullif(strip_all(c), F.lit(""))
    if dtype == "whole":
        return numbers.parse_whole(t)
    if dtype == "number":
        return numbers.parse_number(t)
    if dtype == "boolean":
        return numbers.parse_flag(t)
    if dtype == "timestamp":
        return parse_date(t)
    if dtype == "date":
        return parse_date(t).cast("date")
    return t


def read_export(spark: SparkSession, path: str, contract: Contract, encoding: str | None = None,
    delimiter: str = ",") -> Export:
    """Everything as text first, then columns coerced by the contract.

    Quotes are honoured, doubled quotes too, and line breaks in them: only a
    file that has such is read in one piece, all others split. A
    declared column that is absent is an error that names it; an undeclared
    one is kept as text and reported. A line of white space only is no row, a
    row of empty cells is.
    """
    told, broken = layout(spark, path)
    e = encoding or told
    spark_encoding = "UTF-8" if e.startswith(
        "utf-8") else "ISO-8859-1"  # of Windows-1252, Spark reads what Latin-1 shares
    opts = {"header": "true", "quote": '"', "escape": '"', "multiLine": str(broken).lower(), "encoding": spark_encoding,
        "sep": delimiter, "nullValue": "", "emptyValue": ""}
    raw = spark.read.options(**opts).csv(path)
    names = [c.strip().lstrip("﻿") for c in raw.columns]
    if e == "cp1252":
        raw = raw.select(*[F.translate("`" + c.replace("`", "``") + "`", *_CONTROLS) for c in raw.columns])
        names = [c.translate(str.maketrans(*_CONTROLS)) for c in names]
    raw = raw.toDF(*names)
    declared = [c.name for c in contract.columns]
    if missing := [c for c in declared if c not in names]:
        raise MissingColumns(f"{contract.slug}: missing {', '.join(missing)}")
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    if len(names) > 1:
        blank = strip_all(F.coalesce(q(names[0]), F.lit("x"))) == ""
        for c in names[1:]:
            blank = blank & q(c).isNull()
        raw = raw.where(~blank)
    extra = [c for c in names if c not in declared]
    out = raw.select(
        *[typed(q(c.name), c.dtype).alias(c.name) for c in contract.columns],
            *[F.nullif(strip_all(q(c)), F.lit("")).alias(c) for c in extra],
        *[F.nullif(strip_all(q(c.name)), F.lit("")).alias(f"_raw_{c.name}") for c in contract.columns
            if c.dtype != "string"],
    )
    return Export(out.select(*["`" + c.replace("`", "``") + "`" for c in [*declared, *extra]]), out, extra)


def local_path(drop: str, slug: str) -> str:
    return f"{drop.rstrip('/')}/{slug}.csv"


def token_name(prefix: str, slug: str) -> str:
    """Environment variable that holds an export's token."""
    return prefix + re.sub(r"[^A-Z0-9]+", "_", slug.upper())


def fetch_url(url: str, prefix: str, slug: str) -> tuple[str, str]:
    """(url with the token, url fit for logs); a missing token is an error."""
    name = token_name(prefix, slug)
    token = os.environ.get(name)
    if not token:
        raise KeyError(f"environment variable {name} is not set")
    p = urlsplit(url)
    query = "&".join(x for x in (p.query, f"h={token}") if x)
    return urlunsplit(p._replace(query=query)), urlunsplit(p._replace(query=(p.query + "&" if p.query
        else "") + "h=<REDACTED>"))


def fetch(url: str, prefix: str, slug: str, drop: str, timeout: float = 120) -> str:
    """Download an export to where ``local_path`` looks for it; gives the address fit for logs.

    The file appears under its name only when it is whole. ``drop`` is a folder
    that the driver writes and the executors read.
    """
    full, safe = fetch_url(url, prefix, slug)
    path = local_path(drop, slug)
    part = f"{path}.part"
    try:
        with urllib.request.urlopen(full, timeout=timeout) as answer, open(part, "wb") as out:  # noqa: S310
            shutil.copyfileobj(answer, out, 1 << 20)
    except OSError as e:
        raise OSError(f"{safe}: {type(e).__name__}") from None  # the error's own text has the token
    os.replace(part, path)
    return safe


def profile(spark: SparkSession, path: str, cap: int = 2_000_000) -> DataFrame:
    """One row on a CSV file: encoding, delimiter, headers, n_rows, ragged, capped.

    Lines are counted where they are read. A line's fields are its delimiters
    outside quotes, and one more; ``ragged`` has another number than the
    header. Of more than ``cap`` rows ``n_rows`` is the cap, which ``capped`` tells;
    all lines are read, in as many tasks as the file splits into. A file with line breaks in quotes has to be probed whole (``files.probe``).
    """
    encoding, broken = layout(spark, path)
    if broken:
        raise ValueError(f"{path}: quoted line breaks")
    lines = spark.read.text(path).where(strip_all(F.col("value")) != "")
    first = lines.limit(1).collect()
    if not first:
        return spark.createDataFrame([(encoding, None, [], 0, 0, False)],
            "encoding string, delimiter string, headers array<string>, n_rows bigint, ragged bigint, capped boolean")
    head = first[0]["value"].lstrip("﻿")
    delimiter = max(",;\t|", key=lambda d: (head.count(d), -",;\t|".index(d)))
    bare = F.regexp_replace("value", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1
    headers = [h.strip().strip('"') for h in head.split(delimiter)] if '"' not in head else next(csv.reader([head],
        delimiter=delimiter))
    counted = lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(fields != len(headers)).alias("ragged"))
    n = F.col("n") - 1
    return counted.select(
        F.lit(encoding).alias("encoding"), F.lit(delimiter).alias("delimiter"),
            F.array(*map(F.lit, headers)).alias("headers"), F.least(n, F.lit(cap)).alias("n_rows"), "ragged",
                (n > cap).alias("capped"),
    )
