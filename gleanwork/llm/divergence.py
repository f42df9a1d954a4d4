"""Audit of how far the sources of a language diverge in their words.

Terms are counted in Arrow tasks, straight on the bytes of a batch. A term of at most 8 bytes becomes one
64-bit word and one of at most 16 bytes two, first byte in the highest place, so that the order of the
words is the order of the bytes; they are radix-sorted by 16 bits at a time and counted by runs. Longer
terms go to buckets by length (17 to 32 bytes, 33 to 64, ...), each sorted by bytes. Spark sums up the
counts of a task before it shuffles them.

Every pair of sources is compared over all kept terms of the language. Terms are dealt to parts and sources
to blocks, so a task holds two blocks of sources against one part of the terms, whatever their numbers are,
and returns one sum per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.llm.byte_words import find_runs, pack, slices, text_bytes
from gleanwork.llm.common import full_text, table
from gleanwork.workspace import materialise

LEAST_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Bytes of text that are counted at once, terms of a part, sources of a block: sizes of work, not limits.
SLICE_BYTES = 8 << 20
PART_TERMS = 8192
BLOCK_SOURCES = 64

_CODES = np.arange(256, dtype=np.uint8)
UPPER = (_CODES >= 0x41) & (_CODES <= 0x5A)
LETTER = UPPER | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)
LOWER = np.where(UPPER, _CODES + 32, _CODES).astype(np.uint8)

COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())]
)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by the keys, the last one first in rank; numpy sorts 16 bits by radix."""
    order = np.arange(len(keys[0]))
    for key in keys:
        key = key.astype(np.uint64)
        for shift in range(0, 64, 16):
            digit = (key >> np.uint64(shift)).astype(np.uint16)
            if digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def count_runs(keys: list[np.ndarray], texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and number of different texts of each run of equal sorted keys."""
    fresh = np.ones(len(texts), bool)
    fresh[1:] = False
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(fresh)
    new_text = fresh.copy()
    new_text[1:] |= texts[1:] != texts[:-1]
    return first, np.diff(np.append(first, len(texts))), np.add.reduceat(new_text.astype(np.int64), first)


def count_terms(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray):
    """``(groups, terms, occurrences, texts)`` of each bucket of terms; ``groups`` numbers the texts' groups."""
    starts, lengths = find_runs(LETTER, data, offsets)
    texts = np.searchsorted(offsets, starts, "right") - 1
    data = LOWER[data]
    bits = np.frexp(np.maximum(lengths - 1, 7))[1]  # 3: up to 8 bytes, 4: up to 16, ...
    for size_bits in np.unique(bits):
        chosen = np.flatnonzero(bits == size_bits)
        begin, length, text = starts[chosen], lengths[chosen], texts[chosen]
        group, size = groups[text], 1 << int(size_bits)
        if size <= 16:
            words = pack(data, begin, length, size // 8)
            order = radix_order([*reversed(words), group])
            words = [word[order] for word in words]
            keys = words
        else:
            padded = np.concatenate([data, np.zeros(size, np.uint8)])
            rows = np.lib.stride_tricks.sliding_window_view(padded, size)[begin]
            rows[np.arange(size) >= length[:, None]] = 0
            terms = rows.view(f"S{size}").ravel()
            order = np.argsort(terms, kind="stable")
            order = order[radix_order([group[order]])]
            terms = terms[order]
            keys = [terms]
        first, n, docs = count_runs([*keys, group[order]], text[order])
        if size <= 16:
            terms = np.stack([word[first] for word in words], axis=1).astype(">u8").view(f"S{size}").ravel()
        else:
            terms = terms[first]
        yield group[order][first], terms.tolist(), n, docs


def _count_batches(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(2))
        numbers: dict[tuple, int] = {}
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        groups = np.asarray([numbers.setdefault(pair, len(numbers)) for pair in pairs], np.int64)
        names = list(numbers)
        # A row without a term for each group, as a group may have none.
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, _ in names], pa.string()),
                pa.array([source for _, source in names], pa.string()),
                pa.nulls(len(names), pa.binary()),
                pa.array([0] * len(names), pa.int64()),
                pa.array([0] * len(names), pa.int64()),
            ],
            schema=COUNTS,
        )
        langs = pa.array([lang for lang, _ in names], pa.string())
        sources = pa.array([source for _, source in names], pa.string())
        for row, end in slices(offsets, SLICE_BYTES):
            part = data[offsets[row] : offsets[end]]
            for group, terms, n, docs in count_terms(part, offsets[row : end + 1] - offsets[row], groups[row:end]):
                at = pa.array(group)
                columns = [langs.take(at), sources.take(at), pa.array(terms, pa.binary()), pa.array(n), pa.array(docs)]
                yield pa.RecordBatch.from_arrays(columns, schema=COUNTS)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms))``, exact; NULL where there are no terms."""
    above = (count + PRIOR).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif(total + terms * PRIOR, F.lit(0)).cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


_SUMS = pa.schema(
    [
        ("lang", pa.string()), ("a", pa.string()), ("b", pa.string()),
        ("value", pa.int64()), ("seen", pa.int64()), ("gap", pa.int64()), ("terms", pa.int64()),
    ]
)


def _compare_tile(key: tuple, rows: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of ``abs(p - q)`` over the terms of a part that occur in the two blocks, for each pair of them."""
    lang, _, low, high = (value.as_py() for value in key)
    names, base = sources.column("source").to_pylist(), sources.column("base").to_numpy()
    block, terms = sources.column("block").to_numpy(), sources.column("terms").to_numpy()
    place = {name: i for i, name in enumerate(names)}
    term = rows.column("term").combine_chunks().dictionary_encode()
    seen = len(term.dictionary)
    shares = np.repeat(base[:, None], seen, axis=1)
    at = [place[name] for name in rows.column("source").to_pylist()]
    shares[at, term.indices.to_numpy()] = rows.column("p").to_numpy()
    out: list[list] = [[], [], [], []]
    others = np.flatnonzero(block == high)
    for i in np.flatnonzero(block == low):
        beside = others[others > i] if low == high else others
        out[0] += [names[i]] * len(beside)
        out[1] += [names[j] for j in beside]
        out[2].append(np.abs(shares[beside] - shares[i]).sum(axis=1))
        out[3].append(np.abs(base[beside] - base[i]))
    many = len(out[0])
    values, gaps = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out[2:])
    columns = [[lang] * many, *out[:2], values, [seen] * many, gaps, [int(terms[0])] * many]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _SUMS)], schema=_SUMS)


def _pair_sums(kept: DataFrame, facts: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for each pair of sources of a language, once."""
    by_lang = facts.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_SOURCES).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.max("terms") / PART_TERMS)).cast("int").alias("parts"),
    )
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    part = F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part")
    beside = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("beside")
    tile = ["lang", "part", F.least("block", "beside").alias("low"), F.greatest("block", "beside").alias("high")]
    base = F.coalesce(_share(F.lit(0), F.col("total"), F.col("terms")), F.lit(0)).alias("base")
    sides = (
        facts.join(by_lang, "lang")
        .select("lang", "source", base, "terms", block, "blocks", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .select("*", beside)
        .select(*tile, "source", "base", "terms", "block")
    )
    rows = kept.join(by_lang, "lang").select("lang", "source", "term", "p", block, "blocks", part)
    rows = rows.select("*", beside).select(*tile, "source", "term", "p")
    keys = ["lang", "part", "low", "high"]
    sums = rows.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(
        _compare_tile, "lang string, a string, b string, value long, seen long, gap long, terms long"
    )
    # Terms that neither block has differ by the gap of the shares that unseen terms get.
    return sums.groupBy("lang", "a", "b").agg(
        (F.sum("value") + (F.max("terms") - F.sum("seen")) * F.max("gap")).alias("value")
    )


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS, top: int = TOP
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from the others of its language.

    Part ``pair`` lists every other source with the sum of the differences of all shares, part ``term`` the
    ``top`` terms with a share above that of the language. Null texts, languages and sources are empty. Rows
    count one by one, ids don't matter; a group without terms still meets the others, and a language without
    kept terms has differences of 0. Texts are read whole. An empty table gives no rows.
    """
    rows = docs.select(full_text(lang).alias("lang"), full_text(source).alias("source"), full_text(text).alias("text"))
    counted = rows.mapInArrow(_count_batches, "lang string, source string, term binary, n long, docs long")
    counts = materialise(
        counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit-counts"
    )
    found = counts.where("term IS NOT NULL")
    vocabulary = found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    vocabulary = vocabulary.where(F.col("docs") >= least).drop("docs")
    kept = materialise(
        found.drop("docs").join(vocabulary, ["lang", "term"]).withColumn("term", F.col("term").cast("string")), "audit-kept"
    )
    by_lang = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
    by_lang = by_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    facts = materialise(
        counts.where("term IS NULL")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(by_lang, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"]),
        "audit-groups",
    )
    shares = kept.join(facts, ["lang", "source"]).select(
        "lang", "source", "term",
        _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        shares.where("p > q")
        .select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top)
    )
    ends = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")]
    pairs = (
        _pair_sums(shares, facts)
        .select("lang", F.explode(F.array(*ends)).alias("ends"), "value")
        .select("lang", "ends.source", "ends.item", "value")
        .withColumn("rank", F.row_number().over(ranked))
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text
  FROM documents
), found AS (
  SELECT row_no, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM texts
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT row_no) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q
  FROM totals JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), answer AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM answer
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

BOOK = {"op13_source_divergence": (op13_source_divergence, SQL)}
