import pytest
from pyspark.sql import functions as F

from harborline.functions import dates, numbers, text


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [("PARENT : child ", "CHILD"), ("A : B : c\t d", "C D"), ("PARENT : ", None),
    (None, None), (" x", " X"), ("plain", "PLAIN")])
def test_canonical_sku(spark, raw, want):
    assert one(spark, raw, text.canonical_sku) == want


@pytest.mark.parametrize(
    "raw,want", [("1,204", 1204.0), ("(35)", -35.0), (" 7 ", 7.0), ("1d", None), ("NaN", None), ("inf", None),
        ("", None), ("n/a", None), ("(1,000.5)", -1000.5), ("1e3", 1000.0), (None, None)]
)
def test_parse_number(spark, raw, want):
    assert one(spark, raw, numbers.parse_number) == want


def test_whole_numbers_round_half_to_even(spark):
    assert [one(spark, x, numbers.parse_whole) for x in ("2.5", "3.5", "x")] == [2, 4, None]


def test_floor_zero_keeps_null(spark):
    assert [one(spark, x, numbers.floor_zero, "int") for x in (-3, 4, None)] == [0, 4, None]


def test_clamp_and_ratio(spark):
    assert [one(spark, x, lambda c: numbers.clamp(c, 0.0, 1.0), "double") for x in (-1.0, 0.5, 9.0, None)] == [0.0, 0.5,
        1.0, None]
    assert one(spark, 0, lambda c: numbers.ratio(F.lit(5), c), "int") is None


@pytest.mark.parametrize("row,want", [((12, 24, 9.0), 6.0), ((12, 0, 3.0), 4.0), ((12, 0, 0.0), 999.0),
    ((0, 0, 0.0), 0.0)])
def test_months_of_supply(spark, row, want):
    df = spark.createDataFrame([row], "o int, f int, r double")
    assert df.select(numbers.months_of_supply(F.col("o"), F.col("f"), F.col("r"))).first()[0] == want


@pytest.mark.parametrize("raw,want", [("2024-01-31", "2024-01-31 00:00:00"), ("1/2/2024", "2024-01-02 00:00:00"),
    ("01-2025", "2025-01-01 00:00:00"), ("nope", None), (None, None)])
def test_parse_date(spark, raw, want):
    got = one(spark, raw, lambda c: dates.parse_date(c).cast("string"))
    assert got == want


def test_header_tokens(spark):
    assert one(spark, "POL / Port", lambda c: text.has_tokens(c, "PO")) is False
    assert one(spark, "PO # (main)", lambda c: text.has_tokens(c, "po main")) is True
    assert one(spark, "Qty-On Hand", text.header_key) == "qtyonhand"


def test_redact_runs_rules_in_turn(spark):
    df = spark.createDataFrame([("see https://h/x?h=abc123&q=1 and h=zz9 secret",), (None,)], "t string")
    rules = {"link": r"([?&]h=)[a-z0-9]+", "bare": r"(\bh=)[a-z0-9]+", "word": "secret", "none": "qqq"}
    got = text.redact(df, "t", rules).collect()
    assert (got[0].t, got[0].hits) == ("see https://h/x?h=<REDACTED>&q=1 and h=<REDACTED> <REDACTED>",
        {"link": 1, "bare": 1, "word": 1})
    assert (got[1].t, got[1].hits) == (None, {})


def test_default_redaction_keeps_what_may_be_seen(spark):
    rows = [
        "https://x/media.nl?id=5&h=abcdEFGH_-12", "ftp://me:hunter22@host/p", "https://b/c?sig=abcdefghij%3D&x=1",
            "a?Token=s3cr3t-value&z=1",
        "Authorization: bearer abcdefghijklmnop.q", "Server=x;Password = p4ss;Uid=someone", "?key=short",
    ]
    got = text.redact(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string"),
        "t").orderBy("i").collect()
    assert [r.t for r in got] == [
        "https://x/media.nl?id=5&h=<REDACTED>", "ftp://me:<REDACTED>@host/p", "https://b/c?sig=<REDACTED>&x=1",
            "a?Token=<REDACTED>&z=1",
        "Authorization: bearer <REDACTED>", "Server=x;Password =<REDACTED>;Uid=<REDACTED>", "?key=short",
    ]
    assert [list(r.hits.items()) for r in got] == [
        [("media_token", 1)], [("embedded_credentials", 1)], [("signature", 1)], [("api_key", 1)],
            [("bearer_token", 1)], [("connection_secret", 2)], []
    ]


def test_formula_pattern_folds_all_rows(spark):
    assert one(spark, "=IF(A12>0,SUM($C$2:D12)) ", text.formula_pattern) == "=IF(A{r}>0,SUM($C{r}:D{r}))"


def test_formula_parts(spark):
    f = "=N(A1)+T.INV_2T (0.5)*SUM('Lead Times'!C:C,Stock!$A:$B)+IF(#REF!A1,#DIV/0!,1)"
    assert one(spark, f, text.formula_functions) == ["IF", "SUM", "T.INV_2T"]
    assert one(spark, f, text.formula_columns) == ["$A:$B", "C:C"]
    assert one(spark, f, text.formula_errors) == ["#DIV/0!", "#REF!"]
    assert one(spark, f, text.formula_sheets) == ["Lead Times", "Stock"]


@pytest.mark.parametrize("cell,want", [('"a ""b"" (c)"', True), ("=1.5", True), ("-1,200.5%", True), ("=A1", False),
    ("A", False)])
def test_is_literal(spark, cell, want):
    assert one(spark, cell, text.is_literal) is want


@pytest.mark.parametrize(
    "name,want",
    [
        ("dir/Stock Report v2.xlsx", "stockreport"), ("Stock_Report (2).xlsm", "stockreport"),
            ("Plan 2026.xlsx", "plan"), ("2026.xlsx", "2026"),
        ("Plan - Updated - final - copy - v2.xlsx", "plan"), ("Request ABC .xlsm", "requestabc"),
            ("a\\b\\c new rev 7 8.csv", "cnewrev"), ("final.xlsx", ""), ("v1.x", "v1"),
    ],
)
def test_file_stem(spark, name, want):
    assert one(spark, name, text.file_stem) == want


@pytest.mark.parametrize("glob,name,want", [("*[0-9]?.XLS*", "a17.xlsx", True), ("[!a]*", "abc", False),
    ("[!a]*", "bbc", True), ("a.b", "axb", False), ("*(1)*", "x (1).csv", True)])
def test_globs(spark, glob, name, want):
    assert one(spark, name, lambda c: text.matches_any(c, [glob])) is want
