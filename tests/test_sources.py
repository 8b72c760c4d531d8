import base64
import http.server
import io
import struct
import threading
import zipfile

import pytest

from harborline import cli
from harborline.sources import contracts, exports, files, sinks


def contract(**cols):
    return contracts.Contract("inventory", tuple(contracts.Column(k.replace("_", " "), v) for k, v in cols.items()))


def test_read_export(spark, tmp_path):
    p = tmp_path / "inventory.csv"
    p.write_bytes('﻿Name,On Hand,Cat,When,Extra\n"P : A ","1,204","A, ""B""",2024-01-31,e\n   \n"x\ny",1d,,1/2/2024,\n,,,,\n'.encode())
    e = exports.read_export(spark, str(p), contract(Name="string", On_Hand="whole", Cat="string", When="timestamp"))
    rows = e.frame.collect()
    assert [(r["Name"], r["On Hand"], r["Cat"]) for r in rows] == [("P : A", 1204, 'A, "B"'), ("x\ny", None, None),
        (None, None, None)]
    assert e.unexpected == ["Extra"] and str(rows[1]["When"])[:10] == "2024-01-02"
    assert [tuple(r) for r in e.coercion_report().collect()] == [("On Hand", 1)]


def test_missing_column_is_named(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("A\n1\n")
    with pytest.raises(exports.MissingColumns, match="On Hand"):
        exports.read_export(spark, str(p), contract(A="string", On_Hand="whole"))


def test_encodings():
    assert exports.sniff_encoding("né".encode("cp1252") + b"\x80") == "cp1252"
    assert exports.sniff_encoding("né".encode()) == "utf-8-sig"


@pytest.mark.parametrize(
    "data,want",
    [
        ("a,é\n1,2\n".encode(), ("utf-8", False)), ("a,é\n1,2\n".encode("cp1252"), ("cp1252", False)),
            (b"a\n\x81\n", ("latin-1", False)),
        (b"a\n1\n" * 40_000 + "é".encode("cp1252"), ("cp1252", False)), (b'a,b\n"x ""y""",2\n', ("utf-8", False)),
            (b'a\n"x\ny"\n', ("utf-8", True)), (b"", ("utf-8", False)),
    ],
)
def test_layout_is_told_from_the_whole_file(spark, tmp_path, data, want):
    """A byte of another encoding counts wherever it is; only a quoted line break keeps a file in one piece."""
    p = tmp_path / "x.csv"
    p.write_bytes(data)
    assert exports.layout(spark, str(p)) == want


def test_a_late_byte_is_not_replaced(spark, tmp_path):
    p = tmp_path / "inventory.csv"
    p.write_bytes(b"Name,Q\n" + b"plain,1\n" * 20_000 + "Café €,2\n".encode("cp1252"))
    e = exports.read_export(spark, str(p), contract(Name="string", Q="whole"))
    assert [tuple(r) for r in e.frame.where("Q = 2").collect()] == [("Café €", 2)]


def test_large_files_are_listed_but_not_read(spark, tmp_path):
    (tmp_path / "big.csv").write_bytes(b"x" * 2_000_000)
    (tmp_path / "small.csv").write_bytes(b"a,b\n1,2\n")
    found = files.sweep(spark, [str(tmp_path)], [".csv"])
    assert found.count() == 2
    got = {r.path.rsplit("/", 1)[1]: (r.content is None, r.error) for r in files.contents(spark, found, max_mb=1).collect()}
    assert got.pop("small.csv") == (False, None) and got and all(
        gone and error.endswith("exceeds the limit of 1 MB") for gone, error in got.values())
    probes = files.probe(files.contents(spark, found, max_mb=1))
    assert {r.path.rsplit("/", 1)[1] for r in probes.where("error like '%exceeds the limit%'").collect()} == set(got)
    assert "length" in files.contents(spark, found, max_mb=1)._jdf.queryExecution().executedPlan().toString().split(
        "PushedFilters")[1][:200]


def test_header_row_as_aggregate_and_in_a_probe(spark):
    rows = [["Title"], ["1", "2", "3"], ["SKU", "Qty", "Qty"], ["SKU", "Qty", "Region"], ["a", "b", "c"],
        ["x", "1", "2"]]
    assert files.header_row(rows) == (3, 0.85) and files.header_row([["1", "2"], ["x"]]) == (-1,
        0.0) and files.header_row([]) == (-1, 0.0)
    cells = [("p", "s", i + 1, chr(65 + j), v) for i, r in enumerate(rows) for j,
        v in enumerate(r)] + [("p", "t", 1, "A", "only")]
    got = files.header_rows(spark.createDataFrame(
        cells, "path string, sheet string, row bigint, col string, value string")).collect()
    assert [(r.sheet, r.row, r.confidence) for r in got] == [("s", 4, 0.85)]


def test_tokens(monkeypatch):
    monkeypatch.setenv("TOK_OPEN_PO", "s3cr3t")
    full, safe = exports.fetch_url("https://host/x?id=1", "TOK_", "open-po")
    assert full.endswith("id=1&h=s3cr3t") and "s3cr3t" not in safe
    with pytest.raises(KeyError):
        exports.fetch_url("https://host/x", "TOK_", "other")


def test_fetch_writes_whole_files_and_hides_the_token(tmp_path, monkeypatch):
    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            good = "h=s3cr3t" in self.path and "id=1" in self.path
            self.send_response(200 if good else 403)
            self.end_headers()
            self.wfile.write(b"A\n1\n" if good else b"no")

        def log_message(self, *args):
            pass

    monkeypatch.setenv("TOK_OPEN_PO", "s3cr3t")
    with http.server.HTTPServer(("127.0.0.1", 0), Answer) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        at = f"http://127.0.0.1:{server.server_port}/x?id="
        assert exports.fetch(at + "1", "TOK_", "open_po", str(tmp_path)).endswith("id=1&h=<REDACTED>")
        with pytest.raises(OSError) as told:
            exports.fetch(at + "2", "TOK_", "open_po", str(tmp_path))
        server.shutdown()
    assert (tmp_path / "open_po.csv").read_bytes() == b"A\n1\n" and "s3cr3t" not in str(told.value)


def test_profile_of_a_csv(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes('﻿SKU;"Q;ty";Region\n1;2;3\n"a;b";2;3\n1;2\n\n1;2;3\n'.encode())
    told = lambda **how: tuple(exports.profile(spark, str(p), **how).first())
    assert told() == ("utf-8", ";", ["SKU", "Q;ty", "Region"], 4, 1, False)
    assert told(cap=2)[3:] == (2, 1, True)
    p.write_bytes(b"")
    assert told() == ("utf-8", None, [], 0, 0, False)


def test_contracts_merge_and_keep_notes(tmp_path):
    c = contracts.merge("s", [{"Q": "Int64.Type", "T": "type nullable text"}, {"Q": "number", "Z": "any"}])
    assert [(x.name, x.dtype, x.conflicts) for x in c.columns] == [("Q", "number", ("whole",)), ("T", "string", ()),
        ("Z", "string", ())]
    path = str(tmp_path / "c.json")
    contracts.dump([contracts.Contract("s", c.columns, "entity", "by hand")], path)
    contracts.dump([c], path)
    assert contracts.load(path)[0].notes == "by hand" and contracts.load(path)[0].schema()["Q"].metadata == {
        "conflicts": ["whole"]}


def workbook(queries=None):
    out = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = "".join(
        f'<row r="{i}">{c}</row>' for i, c in [(1, cell("A1", "Title")),
            (3, cell("A3", "SKU") + cell("B3", "Qty") + cell("AA3", "Region")),
                (4, cell("A4", "x") + '<c r="B4"><f>1+1</f><v>2</v></c>'), (5, cell("A5", "y")), (6, "<c r=\"A6\"/>")]
    )
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml",
            f'<workbook {ns}><sheets><sheet name="Data" sheetId="1" r:id="r1"/><sheet name="Old" sheetId="2" state="hidden" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        z.writestr("xl/vbaProject.bin", b'x DPB="1" CMG="2"')
        if queries:
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w") as q:
                q.writestr("Formulas/Section1.m", queries)
            blob = struct.pack("<II", 0, len(inner.getvalue())) + inner.getvalue()
            z.writestr("customXml/item1.xml", ('<DataMashup xmlns="m">' + base64.b64encode(blob)
                .decode() + "</DataMashup>").encode("utf-16"))
    return out.getvalue()


def test_sweep_and_probe(spark, tmp_path):
    root = tmp_path / "estate"
    (root / "Archive").mkdir(parents=True)
    m = 'section Section1;\n\nshared #"Open ""PO""" = let a = "x;y", b = 1 in\n  a;\n\nshared Stock = 1;\n'
    (root / "book.xlsm").write_bytes(workbook(m))
    (root / "data.csv").write_bytes("﻿a;b\n1;2\n3\n4;5\n".encode())
    (root / "bad.xlsx").write_bytes(b"no zip")
    (root / "~$book.xlsx").write_bytes(b"")
    (root / "Archive" / "old.csv").write_text("a\n")
    found = files.sweep(spark, [str(root), str(tmp_path / "gone")], [".csv", ".xlsx", ".xlsm"], ["~$*"], ["archive"])
    rows = found.collect()
    assert sorted(r["name"] for r in rows if r["name"]) == ["bad.xlsx", "book.xlsm", "data.csv"]
    assert [r["error"].split(":")[0] for r in rows if r["error"]] == ["unreachable"]
    probes = {(r["path"].rsplit("/", 1)[1], r["sheet"]): r for r in files.probe(files.contents(spark, found)).collect()}
    data = probes["book.xlsm", "Data"]
    assert (data["headers"], data["n_rows"], data["formulas"], data["macros_protected"]) == (["SKU", "Qty", "Region"],
        2, 1, True)
    assert probes["book.xlsm", "Old"]["state"] == "hidden" and probes["bad.xlsx",
        None]["error"].startswith("BadZipFile")
    c = probes["data.csv", None]
    assert (c["encoding"], c["delimiter"], c["headers"], c["n_rows"], c["ragged"]) == ("utf-8-sig", ";", ["a", "b"], 3,
        1)
    texts = {r["query"]: r["text"] for r in files.query_texts(files.contents(spark, found.where("name like '%.xlsm'")))
        .collect()}
    assert set(texts) == {'Open "PO"', "Stock"} and '"x;y"' in texts['Open "PO"']


def test_cells_and_sheet_table(spark):
    df = spark.createDataFrame([("a.xlsx", bytearray(workbook())), ("b.xlsx", bytearray(b"no"))],
        "path string, content binary")
    every = files.cells(df)
    assert [r["error"].split(":")[0] for r in every.where("error is not null").collect()] == ["BadZipFile"]
    assert [tuple(r) for r in every.where("formula is not null").select("sheet", "row", "col", "value", "formula")
        .collect()] == [("Data", 4, "B", "2", "=1+1")]
    rows = files.sheet_table(every, "Data", header=3).orderBy("row").collect()
    assert [(r["SKU"], r["Qty"], r["Region"]) for r in rows] == [("x", "2", None), ("y", None, None)]


def test_sheets_of_several_files_keep_their_own_headers(spark):
    heads = {"a": ["SKU", "Qty"], "b": ["Item"], "c": ["SKU", "SKU", " "]}
    rows = [(p, "S", 1, "ABC"[i], h) for p, hs in heads.items() for i, h in enumerate(hs)]
    rows += [(p, "S", 2, "ABC"[i], f"{p}{i}") for p, hs in heads.items() for i in range(len(hs))] + [("a", "S", 2, "D", "x")]
    cells = spark.createDataFrame(rows, "path string, sheet string, row bigint, col string, value string")
    got = {r.path: r.values for r in files.sheet_rows(cells, "S").collect()}
    assert got == {"a": {"SKU": "a0", "Qty": "a1"}, "b": {"Item": "b0"}, "c": {"SKU": "c0", "SKU (B)": "c1", "": "c2"}}
    one = files.sheet_table(cells, "S", path="c")
    assert one.columns == ["path", "row", "SKU", "SKU (B)", ""] and one.first()["SKU (B)"] == "c1"
    with pytest.raises(ValueError):
        files.sheet_table(cells, "S")


def test_column_index():
    assert [files.column_index(x) for x in ("A1", "Z", "AA3", "BX", "")] == [0, 25, 26, 75, -1]


def test_publish_swaps_a_pointer(spark, tmp_path):
    w = str(tmp_path / "w")
    sinks.publish({"t": spark.range(2)}, w, "run1")
    with pytest.raises(Exception):  # noqa: B017
        sinks.publish({"t": spark.range(5).selectExpr("raise_error('x') as id")}, w, "run2")
    assert sinks.current(spark, w, "t").count() == 2
    sinks.publish({"t": spark.range(7)}, w, "run3")
    assert sinks.current(spark, w, "t").count() == 7
    assert sinks.stamp(spark.range(1), "s", "o", "2024-01-01 00:00:00").first()["data_as_of"] is None


def test_mirror(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "m.db")
    sinks.mirror_sqlite({"t": spark.range(3).selectExpr("id", "timestamp'2024-01-01' as ts")}, path)
    assert sqlite3.connect(path).execute("select sum(id), min(ts) from t").fetchone() == (3, "2024-01-01 00:00:00")
    with pytest.raises(ValueError):
        sinks.mirror_sqlite({"t": spark.range(3)}, path, most=2)


def test_extract_publishes_or_blocks(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    cols = {"po_number": "whole", "po_line": "whole", "item": "string", "ordered": "whole", "received": "whole",
        "remaining": "whole", "closed": "string"}
    path = str(tmp_path / "c.json")
    contracts.dump([contracts.Contract("open_po", tuple(contracts.Column(k, v) for k, v in cols.items()))], path)
    run = lambda i, *more: cli.main(["extract", "--contracts", path, "--drop", str(drop), "--warehouse",
        str(tmp_path / "w"), "--run-id", i, *more])
    assert run("r0") == 2
    (drop / "open_po.csv").write_text(",".join(cols) + "\n1,1,P : a,200,0,150,No\n1,2,P : b,5,1,4,No\n")
    assert run("r1") == 0 and sinks.current(spark, str(tmp_path / "w"), "exceptions").count() == 1
    assert {(r.gate, r.failed, r.checked) for r in sinks.current(spark, str(tmp_path / "w"), "verdicts").collect()} == {
        ("min_rows", 0, 2), ("no_null_keys:po_number", 0, 2), ("no_null_keys:sku", 0, 2), ("non_negative:qty_remaining", 0,
        2), ("unique_grain", 0, 2), ("stale_snapshot", 0, 1)}
    assert sinks.current(spark, str(tmp_path / "w"), "coercions").count() == 0
    (drop / "open_po.csv").write_text(",".join(cols) + "\n1,1,P : a,2,0,2,No\n1,1,P : b,5,1,4,No\n")
    assert run("r2") == 2 and sinks.current(spark, str(tmp_path / "w"), "open_po").count() == 2
    assert run("r3", "--force") == 2 and sinks.current(spark, str(tmp_path / "w"),
        "open_po").where("sku = 'B'").first()["received"] == 1
    (drop / "open_po.csv").write_text(",".join(cols) + "\n1,1,P : a,2,0,2,No\n1,2,P : b,five,1,0,No\n")
    assert run("r4") == 0 and [tuple(r) for r in sinks.current(spark, str(tmp_path / "w"), "coercions").collect()] == [
        ("open_po", "ordered", 1)]
