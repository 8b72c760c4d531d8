"""Text scalars: keys, headers, globs, redaction, formula patterns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(c: str) -> Column:
    """The column of this name, whatever marks the name holds."""
    return F.col("`" + c.replace("`", "``") + "`")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often it is used; as an expression it is copied into each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_all(c: Column) -> Column:
    """Trim all white space; Spark's own trim takes spaces only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def canonical_sku(c: Column, delimiter: str = ":") -> Column:
    """What follows the last delimiter, trimmed, inner white space single, upper case; empty is null."""
    tail = strip_all(F.substring_index(c, delimiter, -1))
    return F.nullif(F.upper(F.regexp_replace(tail, r"\s+", " ")), F.lit(""))


def after_first(c: Column, delimiter: str) -> Column:
    """What follows the first delimiter; null without one."""
    at = F.instr(c, delimiter)
    return F.when(at > 0, F.substring(c, at + F.lit(len(delimiter)), F.length(c)))


def after_last(c: Column, delimiter: str) -> Column:
    """What follows the last delimiter, or the whole text without one."""
    return F.substring_index(c, delimiter, -1)


def header_key(c: Column) -> Column:
    """Header as letters and digits only, lower case."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def header_tokens(c: Column) -> Column:
    """Header as an array of lower-case tokens."""
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda t: t != "")


def has_tokens(c: Column, phrase: str) -> Column:
    """Whether the phrase's tokens adjoin in the header as whole tokens."""
    wanted = " ".join(t for t in re.split("[^a-z0-9]+", phrase.lower()) if t)
    return F.contains(F.concat(F.lit(" "), F.array_join(header_tokens(c), " "), F.lit(" ")), F.lit(f" {wanted} "))


def glob_regex(pattern: str) -> str:
    """Case-insensitive regular expression of a file glob with *, ?, [abc] and [!abc]."""

    def part(m: re.Match[str]) -> str:
        if m[1] is not None:
            inside = m[1].replace("\\", "\\\\").replace("[", "\\[")
            return f"[^{inside[1:]}]" if inside.startswith("!") else f"[{inside}]"
        return {"*": ".*", "?": "."}.get(m[0], re.escape(m[0]))

    body = re.sub(r"\[(!?[^]]+)\]|.", part, pattern, flags=re.S)
    return f"(?is)^{body}$"


def matches_any(c: Column, globs: Sequence[str]) -> Column:
    """Whether any glob matches."""
    out = F.lit(False)
    for g in globs:
        out = out | c.rlike(glob_regex(g))
    return out


#: Secrets that addresses and connection texts carry; group 1 is what may be seen. Fixed values.
REDACT_RULES = {
    "media_token": r"([?&]h=)[A-Za-z0-9_\-]{8,}",
    "embedded_credentials": r'(://[^:/@\s"]+:)[^@/\s"]{3,}(?=@)',
    "signature": r"([?&](?:sig|sv|se)=)[A-Za-z0-9%+/=_\-]{10,}",
    "api_key": r'(?i)([?&](?:api[_-]?key|access[_-]?token|auth|token|key|password|pwd)=)[^&"\s]{6,}',
    "bearer_token": r"(?i)(Bearer\s+)[A-Za-z0-9._\-]{16,}",
    "connection_secret": r'(?i)((?:^|[;,])\s*(?:password|pwd|user id|uid|account[_ ]?key)\s*=)[^;"]{3,}',
}


#: A piece of text, in small letters, that every match of a rule holds: what lacks it isn't searched.
REDACT_NEEDS = {"media_token": "=", "embedded_credentials": "://", "signature": "=", "api_key": "=",
    "bearer_token": "bearer", "connection_secret": "="}


def redact(df: DataFrame, column: str, rules: Mapping[str, str] = REDACT_RULES, mark: str = "<REDACTED>",
    hits: str = "hits", needs: Mapping[str, str] = REDACT_NEEDS) -> DataFrame:
    """``df`` with ``column`` scrubbed and a map of hits by rule, rules without a hit left out.

    Rules run in turn, each on what the former left; what group 1 holds is
    kept, a rule without a group keeps nothing. Only text that holds a rule's
    piece of ``needs`` is searched, and only text with a hit is replaced. Each
    step is a projection of its own, so nothing is computed twice.
    """
    out, counts = df, []
    for i, (name, pattern) in enumerate(rules.items()):
        kept = "$1" if re.compile(pattern).groups else ""
        n = F.regexp_count(column, F.lit(pattern))
        if piece := needs.get(name):
            whole = named(column) if piece.upper() == piece else F.lower(named(column))
            n = F.when(F.contains(whole, F.lit(piece)), n)
        out = out.withColumn(f"_hits{i}", F.coalesce(n, F.lit(0)))
        out = out.withColumn(column, F.when(F.col(f"_hits{i}") > 0, F.regexp_replace(column, pattern, kept + mark))
            .otherwise(named(column)))
        counts.append(F.struct(F.lit(name).alias("key"), F.col(f"_hits{i}").alias("value")))
    found = F.map_from_entries(F.filter(F.array(*counts), lambda e: e["value"] > 0))
    return out.withColumn(hits, found).drop(*[f"_hits{i}" for i in range(len(rules))])


#: Trailing words that mark a file as a version of another. Fixed values.
VERSION_WORDS = (
    "updated", "update", "new", "final", "latest", "current", "copy", "draft", "rev", "revised", "old", "backup", "bak",
        "v2", "v3", "temp", "working"
)


def file_stem(c: Column) -> Column:
    """File name without folders, extension, trailing version words and then trailing numbers; letters and digits only.

    Any number of marks goes; a name that is a number stays.
    """
    name = F.regexp_replace(F.lower(F.substring_index(F.translate(c, "\\", "/"), "/", -1)), r"(?<=.)\.[^.]+$", "")
    words = F.trim(F.regexp_replace(name, "[^a-z0-9]+", " "))
    asset = F.regexp_replace(words, rf"(^| )(?:{'|'.join(VERSION_WORDS)})(?: (?:{'|'.join(VERSION_WORDS)}))*$", "")
    return F.replace(F.regexp_replace(asset, "( [0-9]+)+$", ""), F.lit(" "), F.lit(""))


def safe_name(c: Column) -> Column:
    """Text as a file name: runs of anything but letters, digits, dot and dash become one _."""
    return F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9.-]+", "_"), "^_+|_+$", "")


def formula_pattern(c: Column) -> Column:
    """Formula with the row of every cell reference, relative or absolute, as {r}."""
    return F.regexp_replace(strip_all(c), r"(\$?[A-Z]{1,3})\$?(\d+)", "$1{r}")


def _distinct_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(group))))


def formula_functions(c: Column) -> Column:
    """Distinct names of two letters or more that are called in a formula, sorted."""
    return _distinct_matches(c, r"\b([A-Z][A-Z0-9._]+)\s*\(", 1)


def formula_columns(c: Column) -> Column:
    """Distinct whole-column ranges, sorted."""
    return _distinct_matches(c, r"\$?[A-Z]{1,3}:\$?[A-Z]{1,3}\b")


def formula_errors(c: Column) -> Column:
    """Distinct error literals in a formula's text, sorted: references that were destroyed."""
    return _distinct_matches(c, r"#(?:REF!|NAME\?|VALUE!|DIV/0!|NULL!|NUM!)")


def formula_sheets(c: Column) -> Column:
    """Distinct sheets that a formula refers to, sorted; #REF! is none."""
    quoted = F.regexp_extract_all(c, F.lit(r"'([^']+)'\s*!"), F.lit(1))
    plain = F.regexp_extract_all(c, F.lit(r"(?<![#A-Za-z0-9_.'])([A-Za-z_][A-Za-z0-9_.]*)\s*!"), F.lit(1))
    return F.array_sort(F.array_distinct(F.concat(quoted, plain)))


def is_literal(c: Column) -> Column:
    """Whether a cell's text is a number or a quoted text rather than a computation."""
    return c.rlike(r'^\s*=?\s*("([^"]|"")*"|-?[\d.,]+%?)\s*$')


def first_rule(c: Column, rules: Mapping[str, str], default: str | None = None) -> Column:
    """Label of the first rule (label to regular expression) that the text matches."""
    out = F.lit(default)
    for label, pattern in reversed(rules.items()):
        out = F.when(c.rlike(pattern), F.lit(label)).otherwise(out)
    return out
