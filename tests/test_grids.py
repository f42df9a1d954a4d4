from __future__ import annotations

import csv
import gzip
import io
import json
import random
from contextlib import contextmanager
from zipfile import ZIP_BZIP2, ZIP_DEFLATED, ZipFile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from gleanwork import sources as S
from gleanwork.plans import finished_sheets, run_sheets, run_workbooks
from gleanwork.sinks import read_snapshot
from gleanwork.sources import split_csv

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def relations(*entries):
    lines = "".join(
        f'<Relationship Id="{i}" Type="{LINK}/{kind}" Target="{target}"/>' for i, kind, target in entries
    )
    return f'<?xml version="1.0"?><Relationships xmlns="{PACKAGE}">{lines}</Relationships>'


def workbook(sheets: dict[str, str], strings: str = "", folder: str = "xl") -> bytes:
    """A workbook from sheet names and the XML of their rows."""
    names = "".join(
        f'<sheet name="{name}" sheetId="{i}" r:id="s{i}"/>' for i, name in enumerate(sheets)
    )
    links = [(f"s{i}", "worksheet", f"worksheets/s{i}.xml") for i in range(len(sheets))]
    out = io.BytesIO()
    with ZipFile(out, "w") as archive:
        archive.writestr("_rels/.rels", relations(("m", "officeDocument", f"{folder}/book.xml")))
        archive.writestr(
            f"{folder}/book.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{LINK}"><sheets>{names}'
            '<sheet name="Chart" sheetId="99" r:id="c"/></sheets></workbook>',
        )
        archive.writestr(
            f"{folder}/_rels/book.xml.rels",
            relations(*links, ("c", "chartsheet", "charts/c.xml"),
                      ("t", "sharedStrings", f"/{folder}/strings.xml")),
        )
        archive.writestr(f"{folder}/strings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
        for i, rows in enumerate(sheets.values()):
            archive.writestr(
                f"{folder}/worksheets/s{i}.xml",
                f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>',
            )
    return out.getvalue()


STRINGS = (
    "<si><t>plain</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>hint</t></rPh></si>"
    "<si><t>a_x000D_b</t></si>"
)
ROWS = (
    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
    '<row r="3"><c r="A3"><v>1.50</v></c><c r="B3" t="b"><v>1</v></c><c r="C3" t="e"><v>#N/A</v></c>'
    '<c r="AA3" t="str"><f>1+1</f><v>two</v></c></row>'
    '<row><c t="inlineStr"><is><t>in\nline</t></is></c><c t="s"><v>2</v></c><c/></row>'
)


def files(spark, content: dict[str, bytes | None]):
    rows = [(path, None if body is None else bytearray(body)) for path, body in content.items()]
    return spark.createDataFrame(rows, "path string, content binary")


def test_workbook_cells(spark):
    grids = S.workbook_rows(files(spark, {"/b.xlsx": workbook({"Tab One-A": ROWS, "E": ""}, STRINGS)}))
    rows = S.sheet_rows(grids).orderBy("row_idx").collect()
    assert [(r["path"], r["sheet"], r["sheet_idx"], r["row_idx"]) for r in rows] == [
        ("/b.xlsx", "Tab One-A", 0, 0), ("/b.xlsx", "Tab One-A", 0, 2), ("/b.xlsx", "Tab One-A", 0, 3),
    ]
    assert rows[0]["cells"] == ["plain", "", "rich text"]
    assert rows[1]["cells"] == ["1.50", "true", "#N/A"] + [""] * 23 + ["two"]
    assert rows[2]["cells"] == ["in\nline", "a\rb", ""]


def test_sheet_listing_keeps_empty_sheets(spark):
    listed = S.sheet_listing(files(spark, {"/b": workbook({"One": "", "Two": ROWS}), "/x": b"zip?"}))
    rows = [tuple(r)[:3] for r in listed.orderBy("path", "sheet_idx").collect()]
    assert rows == [("/b", "One", 0), ("/b", "Two", 1), ("/b", "Chart", 2), ("/x", None, None)]


def test_broken_workbooks_do_not_stop_the_others(spark):
    bad_index = '<row><c t="s"><v>9</v></c></row>'
    grids = S.workbook_rows(
        files(spark, {
            "/good": workbook({"A": ROWS}, STRINGS, folder="office"),
            "/text": b"no zip",
            "/none": None,
            "/wide": workbook({"A": '<row><c r="ZZZZZ1"><v>1</v></c></row>'}),
            "/pair": workbook({"A": '<row><c t="inlineStr"><is><t>_xD83D_</t></is></c></row>'}),
            "/half": workbook({"B": bad_index, "C": "<row><c><v>1</v></c></row>"}),
        })
    )
    assert S.sheet_rows(grids).groupBy("path").count().orderBy("path").collect() == [
        ("/good", 3), ("/half", 1), ("/pair", 1),
    ]
    refused = {r["key"]: r["reason"] for r in S.grid_rejects(grids).collect()}
    assert sorted(refused) == ["/half#B", "/none", "/text", "/wide#A"]
    assert refused["/text"].startswith("BadZipFile")


def test_csv_exports(spark):
    exports = {
        "/in/My%20Sheet.csv": b'\xef\xbb\xbfa,"b\r\nc",\r\n\r\nd,"e ""f"""\r\n',
        "/in/Long.csv": b'"' + b"x" * 200_000 + b'"\n',
        "/in/Broken.csv": b'ok\n"open',
        "/in/Latin.csv": b"\xe9",
    }
    grids = S.csv_grid_rows(files(spark, exports))
    rows = {}
    for r in S.sheet_rows(grids).orderBy("row_idx").collect():
        rows.setdefault(r["sheet"], []).append(r["cells"])
    assert rows["My Sheet"] == [["a", "b\r\nc", ""], [""], ["d", 'e "f"']]
    assert len(rows["Long"][0][0]) == 200_000
    refused = sorted(r["key"] for r in S.grid_rejects(grids).collect())
    assert refused == ["/in/Broken.csv#Broken", "/in/Latin.csv#Latin"]


def test_json_exports(spark):
    exports = {
        "/a": {"range": "'It''s one'!A1:C2", "values": [["x", 1, None], [], ["y"]]},
        "/b": {"range": "Plain!A1", "values": [["z"]]},
        "/c": {"range": "Empty!A1"},
    }
    content = {path: json.dumps(body).encode() for path, body in exports.items()}
    grids = S.json_grid_rows(files(spark, {**content, "/d": b"{", "/e": None}))
    rows = [
        (r["sheet"], r["row_idx"], r["cells"])
        for r in S.sheet_rows(grids).orderBy("path", "row_idx").collect()
    ]
    assert rows == [
        ("It's one", 0, ["x", "1", ""]), ("It's one", 1, []), ("It's one", 2, ["y"]),
        ("Plain", 0, ["z"]),
    ]
    assert sorted(r["key"] for r in S.grid_rejects(grids).collect()) == ["/d", "/e"]


def test_wide_form_pads_and_scrubs(spark):
    rows = spark.createDataFrame(
        [("/p", " My Sheet ", 0, 0, ["a\r\nb", "c"]), ("/p", "2 (in Progress)", 1, 0, ["x"])],
        "path string, sheet string, sheet_idx int, row_idx int, cells array<string>",
    )
    assert S.widest_row(rows) == 2
    table = S.to_wide(finished_sheets(rows), 3).collect()
    assert [tuple(r)[4:] for r in table] == [("_my_sheet_", "a b", "c", "")]


def test_sheets_of_a_large_book_are_read_apart(spark):
    """One large sheet and many small ones take several tasks, and give the rows that one task reads."""
    texts = "".join(f"<si><t>text {i}</t></si>" for i in range(50))
    sheets = {f"S{i}": f'<row><c t="s"><v>{i}</v></c><c><v>{i}</v></c></row>' for i in range(40)}
    sheets["Large"] = "".join(f'<row><c t="s"><v>{i % 50}</v></c><c><v>{i}</v></c></row>' for i in range(9000))
    sheets["Broken"] = '<row><c t="s"><v>99</v></c></row>'
    good, cut = workbook(sheets, texts), io.BytesIO()
    with ZipFile(io.BytesIO(good)) as old, ZipFile(cut, "w", ZIP_DEFLATED) as new:
        for name in old.namelist():
            if not name.endswith("/s3.xml"):
                new.writestr(name, old.read(name), ZIP_BZIP2 if name.endswith("/s5.xml") else None)
    damaged = bytearray(good)
    with ZipFile(io.BytesIO(good)) as old:
        at = old.getinfo("xl/worksheets/s40.xml").header_offset
        damaged[at + 200] ^= 0xFF
    books = {"/good": good, "/cut": cut.getvalue(), "/damaged": bytes(damaged), "/no": b"x" * 99, "/none": b""}
    frame = files(spark, books)
    order = ["path", "sheet_idx", "row_idx"]

    def rows(grid):
        return grid.withColumn("error", F.substring_index("error", ":", 1)).orderBy(order).collect()

    whole = rows(S.workbook_rows(frame))
    assert rows(S.workbook_rows_by_sheet(frame)) == whole
    apart = S.workbook_rows_by_sheet(frame, split_bytes=10, unit_bytes=2000)
    assert rows(apart) == whole and sum(r["error"] is not None for r in whole) >= 5
    assert apart.where("path = '/good'").select(F.spark_partition_id()).distinct().count() > 2


def test_many_rows_leave_in_bounded_batches(spark):
    many = "".join(f'<row r="{i}"><c><v>{i}</v></c></row>' for i in range(1, 20_001))
    grids = S.workbook_rows(files(spark, {"/b": workbook({"A": many})}))
    assert grids.selectExpr("sum(CAST(cells[0] AS int)) total").first()[0] == 20_000 * 20_001 // 2


@pytest.mark.parametrize("width", [None, 2])
def test_workbook_job(spark, tmp_path, width):
    source = tmp_path / "in"
    source.mkdir()
    row = '<row><c t="inlineStr"><is><t>{}\nx</t></is></c><c><v>1</v></c></row>'
    (source / "a.xlsx").write_bytes(workbook({"T-1 a": row.format("a"), "U": row.format("u")}))
    (source / "b.xlsx").write_bytes(workbook({"T-1 a": row.format("b")}))
    (source / "c.xlsx").write_bytes(b"broken")
    target, rejects = str(tmp_path / "out"), str(tmp_path / "bad")
    for _ in range(2):
        run_workbooks(
            spark, str(source), target, "2024-02-29", rejects, layout="wide", width=width
        )
    table = read_snapshot(spark, target).orderBy("_c0")
    assert [(r["_c0"], r["_c1"], r["sheet_slug"]) for r in table.collect()] == [
        ("a x", "1", "T_1_a"), ("b x", "1", "T_1_a"), ("u x", "1", "U"),
    ]
    refused = spark.read.parquet(rejects).collect()
    assert [(r["source"], r["key"].rpartition("/")[2]) for r in refused] == [("workbooks", "c.xlsx")]


def test_rows_of_a_sheet_stay_in_order(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for book in range(6):
        rows = "".join(f"<row><c><v>{book * 1000 + i}</v></c></row>" for i in range(1000))
        (source / f"{book}.xlsx").write_bytes(workbook({"A": rows, "B": rows}))
    target = run_workbooks(
        spark, str(source), str(tmp_path / "out"), "2024-02-29", layout="wide", width=1
    )
    files = [p for p in (tmp_path / "out").rglob("part-*.gz")]
    assert len(files) == 2
    assert spark.read.parquet(str(tmp_path / "out" / "_rejects")).isEmpty()
    for path in files:
        lines = gzip.decompress(path.read_bytes()).decode().splitlines()
        assert lines == ['"_c0"'] + [f'"{i}"' for i in range(6000)]
    assert read_snapshot(spark, target).count() == 12_000


@pytest.mark.parametrize("layout", ["lines", "wide", "long"])
def test_files_of_a_large_sheet_follow_each_other(spark, tmp_path, layout):
    """A hot sheet fills several files; read by name they give its rows in order."""
    source = tmp_path / "in"
    source.mkdir()
    for name, n in (("A", 10), ("Hot", 9000), ("Z", 10)):
        (source / f"{name}.csv").write_text("".join(f"{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    target = run_sheets(spark, str(source), str(tmp_path / "out"), "2024-02-29", layout=layout, keep_rejects=False)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = sorted((tmp_path / "out").rglob("sheet_slug=hot/part-*"))
    assert len(files) > 2
    found = []
    for path in files:
        if layout == "long":
            found += [r["cells"][0] for r in spark.read.parquet(str(path)).coalesce(1).collect()]
        else:
            lines = gzip.decompress(path.read_bytes()).decode().splitlines()
            found += [line.split("\t")[-1].strip('"') for line in lines if line != '"_c0"']
    assert found == [str(i) for i in range(9000)]


def test_long_layout(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.xlsx").write_bytes(workbook({"T 1": ROWS}, STRINGS))
    run_workbooks(spark, str(source), str(tmp_path / "out"), "2024-02-29", layout="long")
    stored = spark.read.parquet(str(tmp_path / "out")).orderBy("row_idx").collect()
    assert [len(r["cells"]) for r in stored] == [3, 27, 3]
    assert stored[2]["cells"] == ["in line", "a b", ""] and stored[0]["sheet_slug"] == "T_1"
    with pytest.raises(ValueError, match="deep"):
        run_workbooks(spark, str(source), str(tmp_path / "out"), layout="deep")


@pytest.mark.parametrize("export", ["csv", "json"])
def test_sheet_job(spark, tmp_path, export):
    source = tmp_path / "in"
    source.mkdir()
    for title in ("My Sheet", "2020 (in Progress)"):
        if export == "csv":
            (source / f"{title}.csv").write_text('a,"b\nc"\nd\n')
        else:
            grid = {"range": f"'{title}'!A1:B2", "values": [["a", "b\nc"], ["d"]]}
            (source / f"{title}.json").write_text(json.dumps(grid))
    target = run_sheets(spark, str(source), str(tmp_path / "out"), "2024-02-29", export, layout="wide")
    rows = read_snapshot(spark, target).orderBy("_c0").collect()
    assert [tuple(r) for r in rows] == [("a", "b c", "my_sheet"), ("d", None, "my_sheet")]


def test_broken_sheets_give_no_rows(spark):
    """Neither a short sheet nor one of many batches leaves rows behind when its end cannot be read."""
    long = "a,b\n" * 10_000
    good = '<row r="1"><c r="A1"><v>1</v></c></row>'
    wide = '<row r="2"><c r="XFE2"><v>1</v></c></row>'
    exports = {
        "/short.csv": b'a,b\n"x"y,z\n',
        "/long.csv": (long + '"x"y,z\n').encode(),
        "/bytes.csv": long.encode() + b"\xff\n",
        "/good.csv": long.encode(),
    }
    rows = S.csv_grid_rows(files(spark, exports)).groupBy("path").agg(
        F.count_if(F.expr("error IS NULL")), F.count_if(F.expr("error IS NOT NULL"))
    )
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == {
        "/short.csv": (0, 1), "/long.csv": (0, 1), "/bytes.csv": (0, 1), "/good.csv": (10_000, 0),
    }
    books = S.workbook_rows(files(spark, {"/b.xlsx": workbook({"A": good + wide, "B": good})}))
    assert {(r["sheet"], r["error"] is None) for r in books.collect()} == {("A", False), ("B", True)}


@contextmanager
def splits_of(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def same_grids(spark, folder, size="128b"):
    """Both readers, told apart only by what a broken text says of places within it."""
    whole = S.csv_grid_rows(S.read_binary_files(spark, str(folder), "*.csv"))
    with splits_of(spark, size):
        split = S.split_csv_rows(spark, str(folder), larger_than=0)
    order = ["path", "row_idx"]

    def rows(grids):
        kind = F.substring_index("error", ":", 1).alias("error")
        return grids.withColumn("error", kind).orderBy(order).collect()

    found = rows(whole)
    assert rows(split) == found
    return found


KINDS = [
    "plain,1", '"a\nb",2', '"say ""x""\n\n,",3', "", ",", '"\r\n"', 'é,"ü\n"', "x,\r", '5" pipe,6"', 'a "b" c',
    'x\ry,"z"\r"q\nw"', '""', '"",""', '"a""\n"""', ' "spaced"', "\r", "\r\r", 'tail,"\r"', '"' + "long\n" * 150 + '"',
    '"' + '""' * 200 + '"', "x" * 300, '"' + '"",\n' * 90 + '"',
]


def test_split_exports_equal_whole_ones(spark, tmp_path):
    """Records that cross the borders of one or many splits, quotes in plain cells, carriage returns, a mark at the start."""
    for seed in range(3):
        draw = random.Random(seed)
        ends = [["\n"], ["\r\n"], ["\n", "\r", "\r\n"]][seed % 3]
        text = "".join(draw.choice(KINDS) + draw.choice(ends) for _ in range(60)) + ["", "end", '"e\n"'][seed % 3]
        (tmp_path / f"a b+c%{seed}.csv").write_bytes(("\ufeff" * (seed % 3) + text).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    rows = same_grids(spark, tmp_path)
    assert all(r["error"] is None for r in rows) and len({r["path"] for r in rows}) == 3
    with splits_of(spark, "128b"):
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50


def test_split_exports_are_rejected_as_whole_ones(spark, tmp_path):
    rows = "a,b\n" * 60
    broken = {
        "quote": (rows + '"a"b,c\n' + rows).encode(),
        "open": (rows + '"never closed').encode(),
        "opened": (rows + '"never closed\n' + rows).encode(),
        "bytes": rows.encode() + b"\xff\n",
        "inside": (rows + '"' + "x\n" * 150).encode() + b'\xff\n"\n',
        "late": (rows + '"' + "x\n" * 150 + '" \n').encode(),
    }
    for name, content in broken.items():
        (tmp_path / f"{name}.csv").write_bytes(content)
    (tmp_path / "good.csv").write_text(rows)
    found = same_grids(spark, tmp_path)
    assert sorted(r["path"].rpartition("/")[2] for r in found if r["error"]) == sorted(f"{n}.csv" for n in broken)
    assert len(found) == len(broken) + 60


def test_hostile_exports(spark, tmp_path):
    """Any run of the characters that matter, valid or not."""
    for seed in range(40):
        draw = random.Random(seed)
        size, marks = draw.choice([1, 5, 30, 100, 200]), draw.choice(['"\n,a', '"\n\r,ab', 'ab\n,,"  é', '\n\r"'])
        (tmp_path / f"{seed}.csv").write_bytes("".join(draw.choices(marks, k=size)).encode())
    found = same_grids(spark, tmp_path, "32b")
    assert {r["error"] is None for r in found} == {True, False}


@given(st.text('",\r\nab', max_size=40))
@settings(max_examples=400, deadline=None)
def test_states_of_lines(text):
    """A file parses if and only if its states end outside of a quoted cell; the records are as many."""
    state, records = split_csv.OUTSIDE, 0
    for line in (text[:-1] if text.endswith("\n") else text).split("\n") if text else []:
        state, ended = split_csv.scan_line(line.encode(), state)
        records += ended
    try:
        rows = list(csv.reader(io.StringIO(text, newline=""), strict=True))
    except csv.Error:
        assert state != split_csv.OUTSIDE
    else:
        assert (state, records) == (split_csv.OUTSIDE, len(rows))


def test_endless_rows_are_rejected(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gleanwork.sources.documents.MAX_FILE_BYTES", 1000)
    (tmp_path / "a.csv").write_text("a,b\n" * 300 + '"' + "x\n" * 600 + '"\n' + "c\n")
    (tmp_path / "b.csv").write_text("a,b\n" * 300)
    with splits_of(spark, "256b"):
        grids = S.split_csv_rows(spark, str(tmp_path))
    found = grids.groupBy("path", "error").count().collect()
    assert {(r[0].rpartition("/")[2], r[1], r[2]) for r in found} == {
        ("a.csv", f"ValueError: {split_csv.ENDLESS}", 1), ("b.csv", None, 300),
    }


def test_large_exports_are_read_and_large_workbooks_listed(spark, tmp_path, monkeypatch):
    """What a job reads does not hang on whether it lists rejects."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "Big.csv").write_text('a,"b\nc"\n' * 100)
    (source / "Small.csv").write_text("d\n")
    (source / "a.xlsx").write_bytes(workbook({"A": ROWS}, STRINGS))
    monkeypatch.setattr("gleanwork.sources.documents.MAX_FILE_BYTES", 100)
    for keep in (True, False):
        target = str(tmp_path / f"out-{keep}")
        run_sheets(spark, str(source), target, "2024-02-29", keep_rejects=keep)
        lines = [r["value"] for r in spark.read.text(target).collect()]
        assert len(lines) == 101
        assert sum(line.endswith('"Big"\t"7"\t"a"\t"b c"') for line in lines) == 1
        books = str(tmp_path / f"books-{keep}")
        run_workbooks(spark, str(source), books, "2024-02-29", keep_rejects=keep)
        refused = spark.read.parquet(f"{books}/_rejects").collect()
        assert [r["reason"].split(":")[0] for r in refused] == ["too large"]


def test_lines_keep_sheets_apart(spark, tmp_path):
    """Each row has its own width and its place; the plan does not grow with the width."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "My Sheet.csv").write_text('a\tb,"c ""d"""\n')
    (source / "my_sheet.csv").write_text(",".join("x" * 3000) + "\n")
    target = run_sheets(spark, str(source), str(tmp_path / "out"), "2024-02-29")
    lines = sorted(r["value"] for r in spark.read.text(target).collect())
    assert lines[0].partition("\t")[2] == '"My Sheet"\t"0"\t"a\tb"\t"c ""d"""'
    assert lines[1].count("\t") == 3002 and '"my_sheet"\t"0"\t"x"' in lines[1]
