from __future__ import annotations

import pytest

from gleanwork.__main__ import main
from gleanwork.sinks import read_history, read_snapshot


def test_payloads(spark, tmp_path):
    spark.createDataFrame(
        [("A", 200, '{"data":[{"value":3}]}')], "key string, status int, body string"
    ).write.parquet(str(tmp_path / "in"))
    (tmp_path / "keys.csv").write_text("ori\nA\nB\n")
    main(
        ["--run-date", "2024-02-29", "--rejects", str(tmp_path / "bad"), "payloads",
         str(tmp_path / "in"), str(tmp_path / "out"), "--keys", str(tmp_path / "keys.csv")],
        spark,
    )
    assert read_snapshot(spark, str(tmp_path / "out")).first()["value"] == "3"
    assert spark.read.parquet(str(tmp_path / "bad")).first()["key"] == "B"


def test_requests(spark, tmp_path):
    (tmp_path / "keys.csv").write_text("ori\nA\nB\nA\n")
    arguments = ["requests", str(tmp_path / "keys.csv"), "https://data.example.org/"]
    main([*arguments, str(tmp_path / "out"), "--dataset", "by_race", "--last", "2001"], spark)
    rows = read_snapshot(spark, str(tmp_path / "out")).orderBy("key").collect()
    assert [(r["key"], r["request"]) for r in rows] == [
        (k, f"https://data.example.org/arrest/agencies/{k}/all/race/1995/2001") for k in "AB"
    ]


def test_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A.txt").write_text("X\n")
    arguments = ["--run-date", "2024-02-29", "documents", str(tmp_path / "in"), str(tmp_path / "out")]
    main([*arguments, "--layout", "flat"], spark)
    row = read_history(spark, str(tmp_path / "out"), "filename string, pdftext string").first()
    assert (row["filename"], row["pdftext"]) == ("a.txt", "x")


def test_responses(spark, tmp_path):
    spark.createDataFrame(
        [("http://h/a.csv", "text/csv", None, bytearray(b"1"))],
        "url string, content_type string, content_disposition string, body binary",
    ).write.parquet(str(tmp_path / "in"))
    main(["responses", str(tmp_path / "in"), "raw", str(tmp_path / "out")], spark)
    assert spark.read.parquet(str(tmp_path / "out")).first()["object_key"].endswith("/a.csv")


def test_grids_and_images(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "One.csv").write_text("a,b\n")
    main(["sheets", str(tmp_path / "in"), str(tmp_path / "out"), "--layout", "wide"], spark)
    assert read_snapshot(spark, str(tmp_path / "out")).first()["_c1"] == "b"
    main(["workbooks", str(tmp_path / "in"), str(tmp_path / "books")], spark)
    main(["images", str(tmp_path / "in"), str(tmp_path / "images"), "--lossless"], spark)
    assert spark.read.parquet(str(tmp_path / "images" / "_rejects")).count() == 1


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["moon"])
