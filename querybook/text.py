"""Scalar functions over whole texts and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork import functions as G
from querybook.tables import RUN_DATE, table

# The test texts are clean; these replacements put in carriage returns, tabs and padded lines.
CRLF = ". ", ".\r\n"
PADDED = ", ", " \t\n\t \x0b"


def _crlf(c: str):
    return F.replace(F.col(c), F.lit(CRLF[0]), F.lit(CRLF[1]))


def _padded(c: str):
    return F.concat(
        F.lit(" \t"), F.replace(_crlf(c), F.lit(PADDED[0]), F.lit(PADDED[1])), F.lit("\n\r \n\n")
    )


CRLF_SQL = "replace(text, '. ', '.' || chr(13) || chr(10))"
PADDED_SQL = (
    "(' ' || chr(9) || "
    f"replace({CRLF_SQL}, ', ', ' ' || chr(9) || chr(10) || chr(9) || ' ' || chr(11))"
    " || chr(10) || chr(13) || ' ' || chr(10) || chr(10))"
)
TRIM_SQL = r"regexp_replace({0}, '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g')"
SCRUB_SQL = r"regexp_replace({0}, '(\r\n|\n\r|\r|\n)', ' ', 'g')"
LINES_SQL = (
    "(array_to_string(list_transform(string_split(rtrim({0}, chr(10)), chr(10)), "
    "lambda x: " + TRIM_SQL.format("x") + "), chr(10)) || chr(10))"
)


def newline_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    return documents.unionByName(turns).select("id", G.scrub_newlines(_crlf("text")).alias("text"))


def line_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", G.collapse_lines(_padded("text")).alias("text")
    )


def line_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", G.trim_lines(_padded("text")).alias("text")
    )


def lower_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", G.lower_text("html").alias("html"))


def text_flat_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", G.flat_lower(_crlf("text")).alias("text")
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", G.file_name("url").alias("filename"))


def sheet_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit("\t "), "p_name", F.lit(" "), "p_type", F.lit(" \n"))
    return table(spark, sf_dir, "part").select("p_partkey", G.sheet_slug(title).alias("slug"))


def workbook_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat("p_name", F.lit("-"), "p_type", F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", G.workbook_slug(title).alias("slug"))


def int_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        G.grouped_integer("o_totalprice").alias("price"),
        G.grouped_integer((F.col("o_orderkey") - 7000) * 0.5).alias("half"),
    )


ENDINGS = (".PDF", ".xlsx", ".tar.gz", ".csv?x=1.png", ".HTML#top", ".unknown", "")


def _with_ending():
    ending = F.get(F.array(*[F.lit(e) for e in ENDINGS]), (F.col("page_id") % 7).cast("int"))
    return F.concat(F.lit("file:/data/page"), F.col("page_id"), ending)


ENDING_SQL = (
    "'file:/data/page' || page_id || CASE page_id % 7 "
    + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(ENDINGS))
    + " END"
)
TYPE_SQL = """CASE page_id % 7 WHEN 0 THEN 'application/pdf'
    WHEN 1 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
    WHEN 2 THEN 'application/gzip' WHEN 3 THEN 'text/csv' WHEN 4 THEN 'text/html'
    ELSE 'application/octet-stream' END"""


def file_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", G.file_type(_with_ending()).alias("media_type")
    )


def tagged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _with_ending()
    return table(spark, sf_dir, "pages").select(
        "page_id",
        G.type_tagged_text(path, G.file_type(path), "html", drop="char").alias("without_char"),
        G.type_tagged_text(
            path, G.file_type(path), F.replace("html", F.lit("<p>"), F.lit("\n<p>")), drop="line"
        ).alias("without_line"),
    )


def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        G.run_stamp(RUN_DATE).alias("stamp"),
        G.object_key("raw", "s_name", RUN_DATE).alias("object_key"),
    )


BOOK = {
    "newline_scrub": (
        newline_scrub,
        f"""
        SELECT doc_id AS id, {SCRUB_SQL.format(CRLF_SQL)} AS text FROM documents
        UNION ALL
        SELECT conv_id * 1000 + turn, {SCRUB_SQL.format(CRLF_SQL)} FROM conversations
        """,
    ),
    "line_collapse": (
        line_collapse,
        f"""
        SELECT doc_id, regexp_replace({TRIM_SQL.format(PADDED_SQL)}, '[\\r\\n]+', ' ', 'g') AS text
        FROM documents
        """,
    ),
    "line_trim": (
        line_trim,
        f"SELECT doc_id, {LINES_SQL.format(PADDED_SQL)} AS text FROM documents",
    ),
    "lower_text": (lower_text, "SELECT page_id, lower(html) AS html FROM pages"),
    "text_flat_lower": (
        text_flat_lower,
        f"SELECT conv_id, turn, lower({SCRUB_SQL.format(CRLF_SQL)}) AS text FROM conversations",
    ),
    "file_name": (
        file_names,
        r"""
        SELECT page_id, lower(regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$')) AS filename
        FROM pages
        """,
    ),
    "sheet_slug": (
        sheet_slugs,
        f"""
        SELECT p_partkey, {TRIM_SQL.format(
            "lower(replace(chr(9) || ' ' || p_name || ' ' || p_type || ' ' || chr(10), ' ', '_'))"
        )} AS slug
        FROM part
        """,
    ),
    "workbook_slug": (
        workbook_slugs,
        """
        SELECT p_partkey, replace(replace(p_name || '-' || p_type || ' ', ' ', '_'), '-', '_')
               AS slug
        FROM part
        """,
    ),
    "int_format": (
        int_format,
        """
        SELECT o_orderkey, format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS price,
               CASE WHEN o_orderkey = 6999 THEN '-0'
                    ELSE format('{:,}', CAST(round_even((o_orderkey - 7000) * 0.5, 0) AS BIGINT))
               END AS half
        FROM orders
        """,
    ),
    "file_type": (file_types, f"SELECT page_id, {TYPE_SQL} AS media_type FROM pages"),
    "type_tagged_text": (
        tagged_text,
        f"""
        WITH tagged AS (
            SELECT page_id, replace({ENDING_SQL}, 'file:', '') || ': Type formatted detected -> '
                   || {TYPE_SQL} || chr(10) AS head, html,
                   replace(html, '<p>', chr(10) || '<p>') AS lined FROM pages)
        SELECT page_id, head || substr(html, 2) AS without_char,
               head || CASE WHEN instr(lined, chr(10)) > 0
                            THEN substr(lined, instr(lined, chr(10)) + 1) ELSE '' END
               AS without_line
        FROM tagged
        """,
    ),
    "run_stamp": (
        run_stamps,
        f"""
        SELECT s_suppkey, '{RUN_DATE}' AS stamp, 'raw/{RUN_DATE}/' || s_name AS object_key
        FROM supplier
        """,
    ),
}
