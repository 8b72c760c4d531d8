import json

import pytest
from pyspark.sql import functions as F

from harborline import cli, config
from harborline.operators import entities, joins, reconcile, windows
from harborline.sources import contracts


def load(tmp_path, value):
    p = tmp_path / "c.json"
    p.write_text(value if isinstance(value, str) else json.dumps(value))
    return config.load(str(p))


def test_settings_have_types_and_defaults(tmp_path, monkeypatch):
    monkeypatch.setenv("SHARE", "/mnt/x")
    c = load(tmp_path, {"discovery": {"roots": ["${SHARE}/a"], "header_overlap": 1, "domains": {"d": ["w"]}},
        "canonical": {"locations": None}})
    assert c.discovery.roots == ["/mnt/x/a"] and c.discovery.header_overlap == 1.0 and c.discovery.domains == {"d": [
        "w"]}
    assert c.discovery.max_file_mb == 400 and c.canonical == config.Canonical()


@pytest.mark.parametrize(
    "value,told",
    [
        ({"discovery": {"rotos": []}}, "rotos"), ({"discovery": {"max_file_mb": "4"}}, "max_file_mb"),
            ({"discovery": {"max_file_mb": True}}, "max_file_mb"), ({"other": {}}, "other"),
        ({"discovery": {"roots": ["${NOT_SET_HERE}"]}}, "NOT_SET_HERE"), ({"discovery": []}, "discovery"),
            ({"discovery": {"roots": "x"}}, "roots"), ("{", "c.json"),
    ],
)
def test_anything_else_is_an_error(tmp_path, value, told):
    with pytest.raises(config.ConfigError, match=told):
        load(tmp_path, value)


def test_commands_on_schemas_and_profiles(spark, tmp_path, capsys):
    path = str(tmp_path / "c.json")
    contracts.dump([contracts.merge("s", [{"Q": "Int64.Type"}, {"Q": "number"}])], path)
    assert cli.main(["schemas", "--contracts", path]) == 2 and capsys.readouterr().out == "s\tQ\tnumber\twhole\n"
    row = lambda label, norms: (label, label, "u", {}, [], [("k", norms, "e")], [], [], [])
    profiles = lambda *rows: spark.createDataFrame(rows, reconcile.PROFILE).write.mode("overwrite").parquet(str(
        tmp_path / "p"))
    run = lambda: cli.main(["reconcile", "--profiles", str(tmp_path / "p"), "--out", str(tmp_path / "o")])
    profiles(row("a", ["trim"]), row("b", []))
    assert run() == 2 and spark.read.parquet(str(tmp_path / "o"
        / "findings")).count() == 1 and spark.read.parquet(str(tmp_path / "o" / "forks")).count() == 1
    profiles(row("a", ["trim"]), row("b", ["trim"]))
    assert run() == 0


def test_percentiles_of_counted_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("a", None), (None, 7), ("b", None)], "g string, v int")
    got = {r.g: (r.p50, r.p90, r.n) for r in entities.percentiles(df, ["g"], "v").collect()}
    assert got == {"a": (1.0, pytest.approx(3.4), 3), None: (7.0, 7.0, 1), "b": (None, None, 0)}


def test_ranks_by_bins(spark):
    values = [5.0, 5.0, 0.0, -1.0, None, 1e9, 5.2, 4.9, 1e-3]
    df = spark.createDataFrame([(g, i, v) for g in ("a", "b", None) for i, v in enumerate(values)],
        "g string, i int, v double")
    got = {(r.g, r.i): r.rank for r in windows.ranked(df, ["g"], "v", "i").collect()}
    order = sorted(range(len(values)), key=lambda i: (values[i] is None, -(values[i] or 0), i))
    assert got == {(g, i): k + 1 for g in ("a", "b", None) for k, i in enumerate(order)}


def test_keys_anywhere_in_a_text(spark):
    texts = spark.createDataFrame([(1, "Big Red Cue"), (2, "red"), (3, None), (4, "aXb"), (5, "")], "n int, t string")
    keys = spark.createDataFrame([("RED",), ("x",), ("ed c",), ("none",), ("",), (None,), ("aXbY",)], "k string")
    got = sorted((r.k, r.n) for r in joins.contains_key(keys, texts, "t", "k").select("k", F.col("n")).collect())
    assert got == [("RED", 1), ("RED", 2), ("ed c", 1), ("x", 4)]
