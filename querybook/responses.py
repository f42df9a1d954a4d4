"""Web responses derived from the pages, and HTML tables derived from texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.operators import html_csv, html_rows, join_chunks, response_rejects, route_responses
from gleanwork.plans import landed_objects, run_landing
from gleanwork.workspace import fresh_path
from querybook.tables import RUN_DATE, spread, table

# Content type and disposition by page number; the file name holds the number.
KINDS = (
    ("text/csv; charset=utf-8", 'attachment; filename="Data={}.csv"'),
    ("text/csv", None),
    ("text/html; charset=utf-8", None),
    (
        "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
        'attachment; filename="Book {}.xlsx"',
    ),
    ("application/binary", "attachment; FileName=z{}.zip"),
    ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", None),
    ("image/png", 'attachment; filename="p{}.png"'),
    (None, None),
    ("application/binary; like=officedocument", 'a; filename="b{}.bin", c; x=1; filename=c.bin'),
)


def _kind(position: int) -> Column:
    parts = [kind[position] for kind in KINDS]
    chosen = F.get(F.array(*[F.lit(part) for part in parts]), F.col("page_id") % len(KINDS))
    return F.replace(chosen, F.lit("{}"), F.col("page_id").cast("string"))


def _kind_sql(position: int) -> str:
    cases = " ".join(
        f"WHEN {i} THEN '{kind[position]}'" for i, kind in enumerate(KINDS) if kind[position]
    )
    return f"replace(CASE page_id % {len(KINDS)} {cases} END, '{{}}', CAST(page_id AS VARCHAR))"


TABLE_HEAD = (
    "<TABLE class=t><tr><th>address</th></tr><tr><td>number<td> <b>{0}</b>\n</tr>"
    '<tr><td>say &quot;hi&quot;</td><td>x<br>y &amp; z</td></table>'
)


def page_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.replace(F.lit(TABLE_HEAD), F.lit("{0}"), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select(
        "url",
        _kind(0).alias("content_type"),
        _kind(1).alias("content_disposition"),
        F.concat(head, "html").cast("binary").alias("body"),
    )


ROUTED_SQL = rf"""
    WITH answers AS (
        SELECT page_id, url, {_kind_sql(0)} AS content_type, {_kind_sql(1)} AS disposition,
               replace('{TABLE_HEAD}', '{{0}}', CAST(page_id AS VARCHAR)) || html AS body
        FROM pages),
    parts AS (
        SELECT *, 'csv' AS route, CASE WHEN disposition IS NULL
               THEN lower(regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$'))
               ELSE replace(string_split(disposition, '=')[-1], '"', '') END AS filename
        FROM answers WHERE content_type LIKE '%text/csv%'
        UNION ALL
        SELECT *, 'html', 'html-' || sha256(url)
        FROM answers WHERE content_type LIKE '%text/html%'
        UNION ALL
        SELECT *, 'office',
               unnest(regexp_extract_all(disposition, '(?i); *filename *= *"?([^";,]+)"?', 1))
        FROM answers WHERE content_type LIKE '%officedocument%' AND disposition IS NOT NULL
        UNION ALL
        SELECT *, 'binary',
               unnest(regexp_extract_all(disposition, '(?i); *filename *= *"?([^";,]+)"?', 1))
        FROM answers WHERE content_type LIKE '%application/binary%')
"""


def route_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_responses(page_responses(spark, sf_dir), "raw", RUN_DATE)
    return routed.where("reason IS NULL").select("url", "route", "filename", "object_key")


def response_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response_rejects(route_responses(page_responses(spark, sf_dir), "raw", RUN_DATE))


def response_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies cut into small chunks, and put together again."""
    stored = landed_objects(page_responses(spark, sf_dir), "raw", RUN_DATE, escape_quotes=False, chunk_bytes=4096)
    return join_chunks(stored).select("object_key", "route", F.col("content").cast("string").alias("content"))


def landed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_path(spark, "objects")
    run_landing(page_responses(spark, sf_dir), "raw", target, RUN_DATE, chunk_bytes=4096)
    return join_chunks(spark.read.parquet(target)).select(
        "object_key", F.col("run_date").cast("string").alias("run_date"), F.length("content").alias("bytes")
    )


def _escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as one page with one table row per line."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.concat(
            F.lit("<tr>\n<td>"), _escaped(line), F.lit("</td><td>"), F.col("lang"), F.lit("</td></tr>")
        ),
    )
    page = F.concat(
        F.lit("<html><body><table><tr><th>line</th><th>language</th></tr>"),
        F.array_join(lines, "\n"),
        F.lit("</table></body></html>"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", page.alias("html"))


def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_rows(_text_pages(spark, sf_dir)).where(F.size("cells") > 0)
    return rows.select(
        "doc_id",
        "row_idx",
        F.get("cells", F.lit(0)).alias("line"),
        F.get("cells", F.lit(1)).alias("lang"),
        F.size("cells").alias("n_cells"),
    )


def pages_without_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_csv(table(spark, sf_dir, "pages").select("page_id", "html"))


def _customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as a page: a headed table, a nested one, and cells left open."""
    number = F.col("c_custkey").cast("string")
    page = F.concat(
        F.lit("<table><tr><td>name<td>"), F.col("c_name"), F.lit("<tr><th>none</th>"),
        F.lit('<tr><td>segment "x"</td><td>o<table><tr><td>'), F.col("c_mktsegment"),
        F.lit("</td></tr></table></td><td>  n&deg;&nbsp; "), number, F.lit(" </td></tr></table>"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return spread(customers).select("c_custkey", page.alias("html"))


def csv_reference_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_csv(_customer_pages(spark, sf_dir), escape_quotes=False)


def csv_doubled_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_csv(_customer_pages(spark, sf_dir), escape_quotes=True)


def _customer_csv_sql(mark: str) -> str:
    return f"""
        SELECT c_custkey,
               '"name","' || c_name || '"' || chr(10)
               || '"segment {mark}x{mark}","o ' || c_mktsegment || '","' || c_mktsegment
               || '","n° ' || c_custkey || '"' || chr(10)
               || '"' || c_mktsegment || '"' || chr(10) AS csv
        FROM customer
    """


CSV_OF_PAGE = (
    """chr(10) || '"number","' || page_id || '"' || chr(10)"""
    """ || '"say "hi"","x y & z"' || chr(10)"""
)

BOOK = {
    "route_response": (
        route_response,
        ROUTED_SQL
        + f"""
        SELECT url, route, filename, 'raw/{RUN_DATE}/' || filename AS object_key FROM parts
        """,
    ),
    "response_refused": (
        response_refused,
        f"""
        SELECT url AS "key", CASE page_id % {len(KINDS)} WHEN 5 THEN 'no file name in the header'
               ELSE 'no route for this content type' END AS reason
        FROM pages WHERE page_id % {len(KINDS)} IN (5, 6, 7)
        """,
    ),
    "response_object_key": (
        response_objects,
        ROUTED_SQL
        + f"""
        SELECT 'raw/{RUN_DATE}/' || filename AS object_key, route,
               CASE route WHEN 'html' THEN {CSV_OF_PAGE} ELSE body END AS content
        FROM parts
        """,
    ),
    "landed_objects": (
        landed_roundtrip,
        ROUTED_SQL
        + f"""
        SELECT 'raw/{RUN_DATE}/' || filename AS object_key, '{RUN_DATE}' AS run_date,
               CAST(CASE route WHEN 'html' THEN strlen({CSV_OF_PAGE}) + 2
                    ELSE strlen(body) END AS INTEGER) AS bytes
        FROM parts
        """,
    ),
    "html_rows": (
        table_cells,
        r"""
        WITH lines AS (
            SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS row_idx
            FROM documents)
        SELECT doc_id, CAST(row_idx AS INTEGER) AS row_idx,
               trim(regexp_replace(regexp_replace(line, '[\x{200b}\x{ad}]', '', 'g'),
                                   '[ \t\n\f\r\x{a0}]+', ' ', 'g')) AS line,
               lang, CAST(2 AS INTEGER) AS n_cells
        FROM lines
        """,
    ),
    "html_without_tables": (
        pages_without_tables,
        "SELECT page_id, '' AS csv FROM pages",
    ),
    "html_csv_reference_quotes": (csv_reference_quotes, _customer_csv_sql('"')),
    "html_csv": (csv_doubled_quotes, _customer_csv_sql('""')),
}
