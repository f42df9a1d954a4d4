"""Document fingerprints by MinHash.

Each document has ``HASHES`` minima of universal hash functions over its word shingles, computed in numpy,
16 bits of each written in hexadecimal. Shingles start before the text, so a short text has one for each
of its words. Equal texts have equal fingerprints; the likeness of two is the share of equal minima.

``neighbour_fingerprints`` compares each document with the next one by descending id. Documents are cut
into ranges of ids, and of hashes of the text within one id, by sampled splitters; each range is a task that sorts its
rows and reads them as a stream. The first document of a range is sent to the end of the range before it, so no
step needs all documents in one place. There are at most ``MOST_RANGES`` ranges, which bounds the splitters; beyond
``MOST_RANGES * RANGE_ROWS`` rows ranges are longer, and a task still holds two documents at a time. ``similar_documents`` joins bands of minima in
Spark and verifies Jaccard on the full shingle sets; ``similar_pairs`` does so for a few given queries.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.byte_words import LOWER, NO_SPACE, find_runs, hash_runs, slices, text_bytes
from gleanwork.llm.common import full_text, table
from gleanwork.llm.shingles import WIDTH, band_keys, choose_bands, minhash, permutations, shingles, windows, word_hashes
from gleanwork.workspace import materialise

HASHES = 128
RANGE_ROWS = 4096
MOST_RANGES = 20_000
#: Keys per range from which the splitters are taken.
SAMPLE = 20
THRESHOLD = 0.8
RECALL = 0.999
#: Of the query: pairs right at the threshold are found with this chance, by at most so many minima.
SEARCH_RECALL, SEARCH_HASHES = 0.99, 64
NOTHING = 0xFFFF
BLOCK_BYTES = 2 << 20


def signature(text: str, hashes, functions) -> np.ndarray:
    values = shingles(text, hashes, WIDTH, lead=True)
    return (minhash(values, *functions) & np.uint64(0xFFFF)).astype(np.uint16)


def to_text(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def _key(doc_id, second: int) -> tuple:
    """Null ids before all others, then by id, then by the second key."""
    return (doc_id is not None, 0 if doc_id is None else doc_id, second)


def _stream(schema: pa.Schema):
    """Rows come by range, in order; the last rows of a range, marked as tail, only stand for the next one."""

    def run(batches):
        functions, hashes = permutations(HASHES), word_hashes()
        out: list[tuple] = []
        held = None  # range, id, text, signature of the row that waits for the next one

        def finish(following):
            where, number, text, own = held
            size = len(text)
            edited = text[: size - size // 3] + following[2][: size // 3]
            other = own if edited == text else signature(edited, hashes, functions)
            out.append(
                (
                    number, size, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own),
                    to_text(other), float((own == other).mean()), float((own == following[3]).mean()),
                )
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for where, tail, number, text in zip(*columns):
                if held is None and tail:
                    continue
                row = (where, number, text, signature(text, hashes, functions))
                if held is not None:
                    finish(row)
                held = None if tail else row
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def neighbour_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text is the text with its last third of code points replaced by as many (or all) of the first
    of the next row by descending id; after the last comes the first. Null ids come last, rows of equal id
    in order of a hash of their text. A single row is its own next. Null texts are empty; texts without
    words have one fingerprint, which is like no other. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType
    # The second key falls as the hash of the text grows, so both keys are in falling order.
    second = F.bitwise_not(F.xxhash64("text")).alias("second")
    rows = docs.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text")).select("*", second)
    total = rows.count()
    ranges = max(1, min(MOST_RANGES, -(-total // RANGE_ROWS)))
    keys = rows.select("doc_id", "second")
    if ranges > 1:
        # Every so many rows by a hash of the key: about SAMPLE keys a range, and so a bounded number.
        every = max(1, total // (SAMPLE * ranges))
        found = keys.where(F.pmod(F.xxhash64("doc_id", "second", F.lit(1)), F.lit(every)) == 0).toArrow().to_pylist()
        sampled = sorted(_key(row["doc_id"], row["second"]) for row in found)
        cuts = sorted({sampled[i * len(sampled) // ranges] for i in range(1, ranges)}) if sampled else []
    else:
        cuts = []

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, seconds: pa.Array) -> pa.Array:
        keys = zip(ids.to_pylist(), seconds.to_pylist())
        return pa.array([bisect_right(cuts, _key(*key)) for key in keys], pa.int32())

    ranged = rows.select(range_of(F.col("doc_id"), F.col("second")).alias("range"), "*")
    key = F.struct("doc_id", "second")
    heads = ranged.groupBy("range").agg(F.max(key).alias("head")).orderBy(F.col("range").desc()).collect()
    moves = [(row["head"]["doc_id"], row["head"]["second"], heads[i - 1]["range"]) for i, row in enumerate(heads)]
    first = spark.createDataFrame(moves, f"head_id {kind.simpleString()}, head_second long, before int")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("second") == F.col("head_second"))
    stays = F.struct(F.col("range"), F.lit(False).alias("tail"))
    goes = F.struct(F.col("before").alias("range"), F.lit(True).alias("tail"))
    dealt = (
        ranged.join(F.broadcast(first), is_head, "left")
        .select(
            "doc_id",
            "second",
            "text",
            F.explode(F.when(F.col("before").isNotNull(), F.array(stays, goes)).otherwise(F.array(stays))).alias("to"),
        )
        .select("to.range", "to.tail", "doc_id", "text", "second")
    )
    sorted_rows = dealt.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions(
        "range", "tail", F.col("doc_id").desc_nulls_last(), F.col("second").desc(), "text"
    )
    fields = [
        ("doc_id", to_arrow_type(kind)), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
    return sorted_rows.drop("second").mapInArrow(
        _stream(pa.schema(fields)),
        f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _fingerprint_rows(schema: pa.Schema):
    def run(batches):
        functions, hashes = permutations(HASHES), word_hashes()
        for batch in batches:
            marks = [to_text(signature(text, hashes, functions)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema[0].type), pa.array(marks)], schema=schema)

    return run


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[doc_id].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("fingerprint", pa.string())])
    rows = docs.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text"))
    return rows.mapInArrow(_fingerprint_rows(schema), f"doc_id {kind.simpleString()}, fingerprint string")


def _verify(threshold: float):
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("jaccard", pa.float64())])

    def run(batches):
        hashes = word_hashes()
        for batch in batches:
            found = []
            for query, number, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = shingles(a, hashes, WIDTH, lead=True), shingles(b, hashes, WIDTH, lead=True)
                common = len(np.intersect1d(x, y, assume_unique=True))
                value = 1.0 if a == b else common / max(1, len(x) + len(y) - common)
                if value >= threshold:
                    found.append((query, number, value))
            columns = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def similar_pairs(queries: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``query_id, doc_id, jaccard`` for pairs of ``queries`` and ``docs`` (``doc_id`` long, ``text``) of
    ``threshold`` or more. Candidates share a band of the fingerprint; pairs of a row with itself are left out."""
    bands, rows = choose_bands(threshold, recall, HASHES)
    band = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.lit(bands - 1)),
            lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring("fingerprint", i * (4 * rows) + 1, F.lit(4 * rows))),
        )
    ).alias("band")
    left = document_fingerprints(queries).select(F.col("doc_id").alias("query_id"), band)
    right = document_fingerprints(docs).select("doc_id", band)
    candidates = left.join(right, "band").where("query_id <> doc_id").select("query_id", "doc_id").distinct()
    texts = docs.select("doc_id", full_text().alias("text"))
    asked = queries.select(F.col("doc_id").alias("query_id"), full_text().alias("query_text"))
    pairs = candidates.join(asked, "query_id").join(texts, "doc_id").select("query_id", "doc_id", "query_text", "text")
    return pairs.mapInArrow(_verify(threshold), "query_id long, doc_id long, jaccard double")


def _band_rows(bands: int, rows: int):
    schema = pa.schema([("mark", pa.binary()), ("asked", pa.bool_()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        functions = permutations(bands * rows)
        for batch in batches:
            found = []
            data, offsets = text_bytes(batch.column(2))
            for row, end in slices(offsets, BLOCK_BYTES):
                own = offsets[row : end + 1] - offsets[row]
                part = LOWER[data[offsets[row] : offsets[end]]]
                starts, lengths = find_runs(NO_SPACE, part, own)
                words, at = hash_runs(part, starts, lengths), 0
                for stop in np.searchsorted(starts, own[1:]).tolist():
                    text, at = words[at:stop], stop
                    values = np.unique(windows(text, min(WIDTH, len(text)))) if len(text) else ()
                    found.append(band_keys(minhash(values, *functions), bands, rows).view(np.int64) if len(values) else [])
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _verified(threshold: float):
    schema = pa.schema([("query", pa.binary()), ("copies", pa.int64())])

    def run(batches):
        hashes = word_hashes()
        for batch in batches:
            found = []
            for query, copies, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = shingles(a, hashes), shingles(b, hashes)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common >= threshold * (len(x) + len(y) - common):
                    found.append((query, copies))
            columns = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def similar_documents(
    docs: DataFrame,
    asked,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    most_hashes: int = HASHES,
) -> DataFrame:
    """``id, similar_docs``: for each id of a row for which the column ``asked`` is true, how many other rows are alike.

    Rows are alike if their sets of 5-word shingles have a Jaccard likeness of ``threshold`` or more; equal texts always
    are. Copies become one node before bands of MinHash minima are joined, and candidates are verified on their full
    sets. Null texts are empty; texts without words are like their copies alone. Rows with a null id get no answer,
    of rows with one id the largest one counts. An empty table gives no rows.
    """
    bands, rows = choose_bands(threshold, recall, most_hashes)
    body = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(asked, F.lit(False)).alias("asked"), full_text(text).alias("text")
    ).withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))
    signed = body.select("mark", "asked", "text").mapInArrow(_band_rows(bands, rows), "mark binary, asked boolean, bands array<long>")
    nodes = signed.groupBy("mark").agg(
        F.first("bands").alias("bands"), F.max("asked").alias("asked"), F.count(F.lit(1)).alias("copies")
    )
    nodes = materialise(nodes, "fingerprint-nodes")
    left = nodes.where("asked").select(F.col("mark").alias("query"), F.explode("bands").alias("band"))
    right = nodes.select("mark", F.explode("bands").alias("band"))
    candidates = materialise(
        left.join(right, "band").where("query <> mark").select("query", "mark").distinct().join(nodes.select("mark", "copies"), "mark"),
        "fingerprint-candidates",
    )
    wanted = materialise(
        candidates.select(F.explode(F.array("query", "mark")).alias("mark")).distinct(), "fingerprint-wanted"
    )
    texts = materialise(
        body.select("mark", "text").join(wanted, "mark", "left_semi").groupBy("mark").agg(F.first("text").alias("text")),
        "fingerprint-texts",
    )
    pairs = candidates.join(texts, "mark").join(texts.select(F.col("mark").alias("query"), F.col("text").alias("other")), "query")
    alike = pairs.select("query", "copies", "other", "text").mapInArrow(_verified(threshold), "query binary, copies long")
    more = alike.groupBy(F.col("query").alias("mark")).agg(F.sum("copies").alias("more"))
    answers = nodes.where("asked").join(more, "mark", "left").select(
        "mark", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("similar_docs")
    )
    rows_asked = body.where(F.col("asked") & F.col("id").isNotNull()).select("id", "mark")
    return rows_asked.join(answers, "mark").groupBy("id").agg(F.max("similar_docs").alias("similar_docs"))


def op4_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses of neighbours, and for ids divisible by 50 the number of similar documents."""
    docs = table(spark, sf_dir, "documents")
    similar = similar_documents(docs, F.col("doc_id") % 50 == 0, recall=SEARCH_RECALL, most_hashes=SEARCH_HASHES)
    similar = materialise(similar, "fingerprint-similar")
    marked = neighbour_fingerprints(docs)
    return marked.join(similar.withColumnRenamed("id", "doc_id"), "doc_id", "left")


BOOK = {"op4_minhash_fingerprints": (op4_minhash_fingerprints, None)}
