"""Files and documents derived from the text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.plans import document_text, documents_view, images_text
from gleanwork.sinks import preview
from gleanwork.sources import decode_documents, read_binary_files, read_images
from gleanwork.workspace import fresh_path
from querybook.tables import spread, table
from querybook.text import LINES_SQL, PADDED_SQL, _padded

ENDINGS = (".TXT", ".html", ".pdf", ".csv")


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a file; some of them are in a format that has no decoder."""
    kind = F.col("doc_id") % len(ENDINGS)
    ending = F.get(F.array(*[F.lit(e) for e in ENDINGS]), kind)
    page = F.concat(
        F.lit("<title>a</title><style>b{}</style>"),
        F.replace(F.replace(_padded("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
    )
    content = F.when(kind == 1, page).otherwise(_padded("text"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("s3a://store/In/Doc-"), "doc_id", ending).alias("path"),
        content.cast("binary").alias("content"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_documents(document_files(spark, sf_dir))
    return documents_view(document_text(decoded), "querybook_documents")


def documents_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text only: no decoder, so no Python in the plan."""
    decoded = decode_documents(document_files(spark, sf_dir), decoders={})
    return document_text(decoded.where("error IS NULL"), "flat").withColumn(
        "n_chars", F.length("pdftext")
    )


def document_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_documents(document_files(spark, sf_dir))
    return decoded.where("error IS NOT NULL").select("path", "error")


def sql_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    some_text = F.when(F.col("doc_id") % 3 > 0, F.col("text"))
    named = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), "doc_id").alias("filename"), some_text.alias("pdftext")
    )
    return documents_view(named, "querybook_some_text")


def binary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document texts written as files of many texts, read back as bytes, cut into lines."""
    folder = fresh_path(spark, "texts")
    texts = table(spark, sf_dir, "documents").select("text")
    texts.write.option("maxRecordsPerFile", 1000).text(folder)
    decoded = decode_documents(read_binary_files(spark, folder, "*.txt"), decoders={})
    lines = F.split(F.rtrim("text", F.lit("\n")), "\n")
    return decoded.select(F.explode(lines).alias("line")).where("line <> ''")


def _little_endian(number: Column) -> Column:
    """Four bytes in hex; the number must be below 65536."""
    digits = F.lpad(F.hex(number), 4, "0")
    return F.concat(F.substring(digits, 3, 2), F.substring(digits, 1, 2), F.lit("0000"))


def _bitmap(width: Column, height: Column) -> Column:
    """A grey bitmap of the given size."""
    pixel_bytes = F.ceil(width * 3 / 4).cast("int") * 4 * height
    header = F.concat(
        F.lit("424D"),
        _little_endian(pixel_bytes + 54),
        F.lit("00000000" + "36000000" + "28000000"),  # reserved, start of pixels, header size
        _little_endian(width),
        _little_endian(height),
        F.lit("0100" + "1800" + "00000000"),  # one plane, 24 bits, no compression
        _little_endian(pixel_bytes),
        F.lit("00000000" * 4),  # resolution and colours: not stated
    )
    return F.unhex(F.concat(header, F.repeat(F.lit("80"), pixel_bytes.cast("int"))))


def image_folder(spark: SparkSession, sf_dir: str) -> str:
    """One bitmap file per supplier. The text sink writes bytes as they are, plus a line feed.

    The tasks move their files to the folder themselves: the driver would move them one after the other.
    """
    folder = fresh_path(spark, "images")
    width = F.col("s_suppkey") % 13 + 1
    height = F.col("s_suppkey") % 7 + 1
    (
        spread(table(spark, sf_dir, "supplier").select("s_suppkey"))
        .select(_bitmap(width, height).cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        .text(folder)
    )
    return folder


def image_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = read_images(spark, image_folder(spark, sf_dir))
    return images.groupBy("width", "height", "nChannels").agg(F.count(F.lit(1)).alias("images"))


def image_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = images_text(spark, image_folder(spark, sf_dir))
    return texts.select(F.regexp_replace("text", r"^part-\S*\.txt:", "file:").alias("text"))


def first_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")


_FILE_SQL = "'s3a://store/In/Doc-' || doc_id || CASE doc_id % 4 " + " ".join(
    f"WHEN {i} THEN '{e}'" for i, e in enumerate(ENDINGS)
) + " END"
# A title is a block of its own, so the text of a page starts after its two line ends.
_PAGE_SQL = "(chr(10) || 'a' || chr(10) || chr(10) || chr(10) || " + PADDED_SQL + ")"

BOOK = {
    "document_text": (
        documents,
        f"""
        SELECT lower('doc-' || doc_id || CASE doc_id % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.html'
                     ELSE '.csv' END) AS filename,
               lower(CASE doc_id % 4 WHEN 1 THEN {LINES_SQL.format(_PAGE_SQL)}
                     ELSE {LINES_SQL.format(PADDED_SQL)} END) AS pdftext
        FROM documents WHERE doc_id % 4 <> 2
        """,
    ),
    "document_text_flat": (
        documents_flat,
        r"""
        WITH flat AS (
            SELECT 'doc-' || doc_id || CASE doc_id % 4 WHEN 0 THEN '.txt' ELSE '.csv' END
                   AS filename,
                   lower(regexp_replace(PADDED, '(\r\n|\n\r|\r|\n)', ' ', 'g')) AS pdftext
            FROM documents WHERE doc_id % 4 IN (0, 3))
        SELECT filename, pdftext, CAST(length(pdftext) AS INTEGER) AS n_chars FROM flat
        """.replace("PADDED", PADDED_SQL),
    ),
    "document_rejects": (
        document_rejects,
        f"""
        SELECT {_FILE_SQL} AS path, 'no decoder for application/pdf' AS error
        FROM documents WHERE doc_id % 4 = 2
        """,
    ),
    "sql_not_null": (
        sql_not_null,
        "SELECT 'doc' || doc_id AS filename, text AS pdftext FROM documents WHERE doc_id % 3 > 0",
    ),
    "binary_inventory": (
        binary_files,
        """
        SELECT line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE line <> ''
        """,
    ),
    "image_inventory": (
        image_inventory,
        """
        SELECT CAST(s_suppkey % 13 + 1 AS INTEGER) AS width,
               CAST(s_suppkey % 7 + 1 AS INTEGER) AS height, CAST(3 AS INTEGER) AS "nChannels",
               count(*) AS images
        FROM supplier GROUP BY ALL
        """,
    ),
    "image_text": (
        image_texts,
        """
        SELECT 'file: type formatted detected -> text/plain ' || (s_suppkey % 7 + 1) || ' '
               || (s_suppkey % 13 + 1) || ' 3 ' AS text
        FROM supplier
        """,
    ),
    "preview": (
        first_customers,
        "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10",
    ),
}
