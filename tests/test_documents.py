from __future__ import annotations

import pytest

from gleanwork import sources as S
from gleanwork.plans import document_text, documents_view, images_text, run_documents, run_images
from gleanwork.sinks import preview, read_history, read_snapshot
from querybook.documents import _bitmap


@pytest.fixture(scope="module")
def files(spark):
    rows = [
        ("/in/A.TXT", b" One \r\n\ttwo\n\n"),
        ("/in/b.html", b"<title>T</title><p>x &amp; y<script>no</script></p><td>z</td>"),
        ("/in/c.pdf", b"%PDF"),
        ("/in/d.txt", b"\xff\xfe"),
        ("/in/e.csv", b""),
        ("/in/f.odd", b"bad"),
        ("/in/g.odd", b"good"),
        ("/in/h.html", None),
        ("/in/i.odd", b"none"),
    ]
    rows = [(path, None if body is None else bytearray(body)) for path, body in rows]
    return spark.createDataFrame(rows, "path string, content binary")


def test_decoding(files):
    got = {r["path"]: (r["text"], r["error"]) for r in S.decode_documents(files).collect()}
    assert got["/in/A.TXT"] == (" One \r\n\ttwo\n\n", None)
    assert got["/in/b.html"][0].split() == ["T", "x", "&", "y", "z"]
    assert got["/in/c.pdf"] == (None, "no decoder for application/pdf")
    assert got["/in/d.txt"] == (None, "not valid UTF-8")
    assert got["/in/e.csv"] == ("", None)


def test_own_decoders(files):
    def failing(content: bytes, name: str) -> str:
        if b"bad" in content:
            raise ValueError("cannot read " + name)
        if b"none" in content:
            return None
        return content.decode() + "!\ud800"

    decoded = S.decode_documents(files, {"text/odd": failing}, types={"odd": "text/odd"})
    got = {r["path"]: (r["text"], r["error"]) for r in decoded.collect()}
    assert got["/in/f.odd"] == (None, "ValueError: cannot read /in/f.odd")
    assert got["/in/g.odd"] == ("good!\ufffd", None)
    assert got["/in/i.odd"] == (None, "the decoder gave no text")
    assert got["/in/b.html"] == (None, "no decoder for text/html")


def test_document_rows(files):
    texts = document_text(S.decode_documents(files, {}).where("error IS NULL"))
    rows = {r["filename"]: r["pdftext"] for r in documents_view(texts, "some_documents").collect()}
    assert rows == {"a.txt": "one\ntwo\n", "e.csv": "\n"}
    flat = document_text(S.decode_documents(files, {}), "flat").where("filename = 'a.txt'")
    assert flat.first()["pdftext"] == " one  \ttwo  "
    with pytest.raises(ValueError, match="round"):
        document_text(files, "round")


def test_document_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gleanwork.sources.documents.MAX_FILE_BYTES", 50)
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    (folder / "A.txt").write_bytes(b"One\n\n two \n")
    (folder / "B.pdf").write_bytes(b"%PDF")
    (folder / "C.txt").write_bytes(b"x" * 100)
    target, rejects = str(tmp_path / "out"), str(tmp_path / "bad")
    for _ in range(2):
        run_documents(spark, str(tmp_path / "in"), target, "2024-02-29", rejects_target=rejects)
    rows = read_history(spark, target, "filename string, pdftext string").collect()
    assert [(r["filename"], r["pdftext"], str(r["run_date"])) for r in rows] == [
        ("a.txt", "one\n\ntwo", "2024-02-29")
    ]
    reasons = {r["key"].rpartition("/")[2]: r["reason"] for r in spark.read.parquet(rejects).collect()}
    assert reasons == {"B.pdf": "no decoder for application/pdf", "C.txt": "too large: 100"}
    assert S.read_binary_files(spark, str(tmp_path / "in"), "*.pdf").count() == 1


def test_images(spark, tmp_path):
    from pyspark.sql import functions as F

    bitmap = spark.range(1).select(_bitmap(F.lit(5), F.lit(3))).first()[0]
    (tmp_path / "A.BMP").write_bytes(bytes(bitmap))
    (tmp_path / "B.bmp").write_bytes(b"no image")
    images = S.read_images(spark, str(tmp_path))
    assert [tuple(r)[1:] for r in images.collect()] == [(3, 5, 3)]
    refused = S.image_rejects(spark, str(tmp_path)).collect()
    assert [(r["key"].rpartition("/")[2], r["reason"]) for r in refused] == [
        ("B.bmp", "no readable image")
    ]
    shown = preview(images_text(spark, str(tmp_path)), "filename").collect()
    assert [tuple(r) for r in shown] == [
        ("a.bmp", "a.bmp: type formatted detected -> image/bmp 3 5 3 ")
    ]
    target = run_images(spark, str(tmp_path), str(tmp_path / "out"), "2024-02-29", lossless=True)
    assert [tuple(r) for r in read_snapshot(spark, target, lossless=True).collect()] == [
        ("a.bmp", "a.bmp: type formatted detected -> image/bmp 3 5 3 ")
    ]
    listed = spark.read.parquet(str(tmp_path / "out" / "_rejects")).collect()
    assert [(r["source"], r["key"].rpartition("/")[2]) for r in listed] == [("images", "B.bmp")]


def test_files_too_large_are_listed_without_other_rejects(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gleanwork.sources.documents.MAX_FILE_BYTES", 50)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A.txt").write_text("x" * 51)
    (tmp_path / "in" / "B.pdf").write_text("%PDF")
    run_documents(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2024-02-29", keep_rejects=False)
    listed = spark.read.parquet(str(tmp_path / "out" / "_rejects")).collect()
    assert [r["reason"] for r in listed] == ["too large: 51"]
