"""Similarity join on word n-grams: MinHash bands find candidates, full n-gram sets decide.

1. Rows of the same text become one node (first 128 bits of SHA-256) that knows how many copies it has.
2. A node has one key per band; the number of bands and rows is chosen so that a pair at the threshold
   shares a key with chance ``RECALL``. In each bucket, nodes are linked to its least node.
3. Linked nodes form candidate groups; every candidate pair lies within one. A group is cut into chunks of
   bounded size, and each pair of chunks is a tile, so no group has to fit in one task.
4. In a tile, nodes that share a key are compared on their full n-gram sets. It returns, for each node, how
   many documents it is linked to and one node that it hangs together with: rows in proportion to nodes,
   not to pairs. Each pair meets in exactly one tile, so links are counted once.
5. The classes are the connected components of the verified links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.common import full_text, table
from gleanwork.llm.components import components
from gleanwork.llm.shingles import WIDTH, band_keys, choose_bands, minhash, permutations, shingles, word_hashes
from gleanwork.workspace import materialise

THRESHOLD = 0.8
RECALL = 0.99999
MOST_HASHES = 96
CHUNK_NODES = 1024
CHUNK_SHINGLES = 1_000_000


def node_of(text):
    """The identity of a text."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def _band_rows(width: int, bands: int, rows: int, schema: pa.Schema):
    def run(batches):
        factors, offsets = permutations(bands * rows)
        hashes = word_hashes()
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column(2).to_pylist():
                values = shingles(text, hashes, width)
                sizes.append(len(values))
                signature = minhash(values, factors, offsets)
                keys.append(band_keys(signature, bands, rows).view(np.int64) if len(values) else None)
            arrays = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return run


def links_in_tile(sets: list[np.ndarray], keys: np.ndarray, chunk: np.ndarray, threshold: float):
    """Pairs of positions with a common band key and a Jaccard similarity of ``threshold`` or more.

    With two chunks only pairs across them count. Yields (position, array of later positions).
    """
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum([len(s) for s in sets])
    numbered = np.split(flat.astype(np.int64), ends[:-1])
    sizes = np.diff([0, *ends])
    across = chunk.min() != chunk.max()
    mark = np.zeros(int(flat.max(initial=0)) + 1, bool)
    for i in range(len(sets) - 1):
        near = (keys[i + 1 :] == keys[i]).any(axis=1)
        near &= sizes[i + 1 :] * threshold <= sizes[i]
        near &= sizes[i] * threshold <= sizes[i + 1 :]
        if across:
            near &= chunk[i + 1 :] != chunk[i]
        others = np.flatnonzero(near) + i + 1
        if not len(others):
            continue
        mark[numbered[i]] = True
        common = np.fromiter((np.count_nonzero(mark[numbered[j]]) for j in others), np.int64, len(others))
        mark[numbered[i]] = False
        union = sizes[i] + sizes[others] - common
        linked = others[common >= threshold * union - 1e-9]
        if len(linked):
            yield i, linked


def _verify(width: int, threshold: float):
    schema = pa.schema([("node", pa.binary()), ("linked", pa.int64()), ("texts", pa.int64()), ("tile_root", pa.binary())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        nodes = rows.column("node").to_pylist()
        first = sorted({node: i for i, node in enumerate(nodes)}.values())
        rows = rows.take(pa.array(first))
        nodes = rows.column("node").to_pylist()
        hashes = word_hashes()
        sets = [shingles(text, hashes, width) for text in rows.column("text").to_pylist()]
        keys = np.asarray(rows.column("bands").to_pylist(), np.int64)
        copies = rows.column("copies").to_numpy()
        linked, texts = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        root = list(range(len(nodes)))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        if len(nodes) > 1:
            for i, others in links_in_tile(sets, keys, rows.column("chunk").to_numpy(), threshold):
                linked[i] += copies[others].sum()
                linked[others] += copies[i]
                texts[i] += len(others)
                texts[others] += 1
                for j in others:
                    a, b = find(i), find(int(j))
                    root[max(a, b)] = min(a, b)
        found = np.flatnonzero(texts)
        return pa.Table.from_arrays(
            [
                pa.array([nodes[i] for i in found], pa.binary()),
                pa.array(linked[found]),
                pa.array(texts[found]),
                pa.array([nodes[find(int(i))] for i in found], pa.binary()),
            ],
            schema=schema,
        )

    return run


def similar_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> tuple[DataFrame, DataFrame]:
    """The documents and their texts.

    Documents: ``doc_id, node``. Texts: ``node, copies, first_id, n_shingles, linked, linked_texts,
    class_id, keep_node``; ``linked`` counts the documents of other texts that a text is linked to,
    ``class_id`` is the smallest id of its class, ``keep_node`` the text of that document.

    Words are parted by ASCII white space, A-Z count as lower case. A text of fewer than ``width`` words
    has one n-gram, all its words; a text without words (null counts as empty) is linked to nothing but its
    copies. Copies are linked whatever they hold. Repeated rows count as copies; a null id is larger than
    none, so a class has a null id only if all its ids are null. An empty table gives no rows.
    """
    bands, band_rows = choose_bands(threshold, recall, MOST_HASHES)
    source = docs.select(F.col(doc_id).alias("doc_id"), node_of(full_text(text)).alias("node"), full_text(text).alias("text"))
    id_type = docs.schema[doc_id].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema(
        [("doc_id", to_arrow_type(id_type)), ("node", pa.binary()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )
    documents = materialise(
        source.mapInArrow(
            _band_rows(width, bands, band_rows, schema),
            f"doc_id {id_type.simpleString()}, node binary, n_shingles long, bands array<long>",
        ),
        "join-documents",
    )
    texts = materialise(
        documents.groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("doc_id").alias("first_id"),
            F.max("n_shingles").alias("n_shingles"),
            F.max("bands").alias("bands"),
        ),
        "join-texts",
    )
    keyed = texts.select("node", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = keyed.join(buckets, "band").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    groups = components(stars)
    members = groups.join(texts, "node")
    cuts = members.groupBy("root").agg(
        F.ceil(
            F.greatest(F.count(F.lit(1)) / F.lit(CHUNK_NODES), F.sum("n_shingles") / F.lit(CHUNK_SHINGLES))
        ).alias("chunks")
    )
    members = materialise(
        members.join(cuts, "root").select(
            "node",
            "root",
            "copies",
            "bands",
            F.col("first_id").alias("doc_id"),
            "chunks",
            F.pmod(F.xxhash64("node"), "chunks").alias("chunk"),
        ),
        "join-members",
    )
    same_id = source["doc_id"].eqNullSafe(members["doc_id"])
    with_text = source.join(members, (source["node"] == members["node"]) & same_id).select(
        members["node"], "root", "copies", "bands", "chunks", "chunk", source["text"]
    )
    tiles = (
        with_text.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .select("root", "low", "high", "node", "copies", "bands", "chunk", "text")
    )
    verified = materialise(
        tiles.groupBy("root", "low", "high").applyInArrow(
            _verify(width, threshold), "node binary, linked long, texts long, tile_root binary"
        ),
        "join-links",
    )
    classes = components(verified.select(F.col("node").alias("u"), F.col("tile_root").alias("v")))
    counts = verified.groupBy("node").agg(F.sum("linked").alias("linked"), F.sum("texts").alias("linked_texts"))
    placed = (
        texts.drop("bands")
        .join(classes, "node", "left")
        .join(counts, "node", "left")
        .select(
            "node",
            "copies",
            "first_id",
            "n_shingles",
            F.coalesce("linked", F.lit(0)).alias("linked"),
            F.coalesce("linked_texts", F.lit(0)).alias("linked_texts"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    best = placed.groupBy("root").agg(
        F.min(F.struct(F.col("first_id").isNull().alias("missing"), "first_id", "node")).alias("best")
    )
    return documents.select("doc_id", "node"), placed.join(best, "root").select(
        "node",
        "copies",
        "first_id",
        "n_shingles",
        "linked",
        "linked_texts",
        F.col("best.first_id").alias("class_id"),
        F.col("best.node").alias("keep_node"),
    )


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each class, with its own columns."""
    _, texts = similar_classes(docs, doc_id, text, **options)
    keepers = texts.where("node = keep_node").select(F.col("node").alias("keep"), F.col("first_id").alias("keep_id"))
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("id"),
        node_of(full_text(text)).alias("node"),
    )
    kept = named.join(keepers, (F.col("node") == F.col("keep")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    return kept.groupBy("node", "id").agg(F.first("row").alias("row")).select("row.*")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, texts = similar_classes(table(spark, sf_dir, "documents"))
    return documents.join(texts, "node").select(
        "doc_id", "class_id", (F.col("copies") - 1 + F.col("linked")).alias("links"), "copies", "n_shingles"
    )


BOOK = {"op9_ngram_join": (op9_ngram_join, None)}
