"""Language-model scores from a log-frequency Bloom filter.

Tokens are words (A-Z in lower case) and one end mark per document; a document begins in the context of
the end mark. Words are hashed to 64 bits on the bytes of a batch, pairs of words likewise. One pass over the
training documents counts both, summed up per task, and sends them packed to parts by the range of their hash.
A part adds up its counts, puts them on a scale of powers of ``BASE`` and fills a filter of its own, of
``BITS`` bits a key: a word or pair of level q has the keys (it, 1) ... (it, q), and a reader probes
1, 2, ... until a key is missing. The parts are sent to the workers as one filter, or, where they might be larger than
``MOST_BITS``, stay where they are: texts are then read once and written as chunks of numbered words, the distinct words
and pairs of a chunk go to their parts with its counts, are probed there by the filter that all chunks filled, and only
their levels, in the order of their hashes, come back to the chunk.

Score of a token w after h: ``a(h) * count(h, w) / count(h) + (1 - a(h)) * p(w)``. The count of a pair is the least of
its level, so that pairs seen once count as 1; that of its context is exact for the most frequent words and
the upper bound of its level for others; ``a`` is ``TRUST`` for contexts that training saw and 0 for others. ``p`` is
the middle count of the level over the sum of all, with the share of words seen once set aside for the
unknown word. So probabilities over the known words and one unknown word add up to 1 at most, but for false
hits of the filter.

Bounds: at most ``MOST_BITS`` of the filter go through the driver and to the workers; a document of n characters has at
most n + 3 keys. Exact counts for the base score: the most frequent words, at most ``HEAD``, are sent to the workers and
all others joined by hash; to a chunk they come back with the levels.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleanwork.llm.byte_words import NO_SPACE, find_runs, hash_runs, text_blocks
from gleanwork.llm.common import crc_mod, full_text, table
from gleanwork.llm.shingles import mix
from gleanwork.workspace import materialise

BASE = 1.5
LEVELS = 110
HASHES = 4
BITS = 10
MOST_BITS = 1 << 30
HEAD = 1 << 18
TRUST = 0.9
#: Sizes of work: neither drops anything. Characters of a part, parts of pairs for one of words, bytes of a block and of
#: what is sent at once, pairs and words that a task holds, tokens scored at once.
PART_CHARS = 16 << 20
WORD_SHARE = 8
BLOCK_BYTES = 2 << 20
SENT_BYTES = 4 << 20
LOCAL_PAIRS = 4_000_000
LOCAL_WORDS = 1_000_000
STEP = 1 << 18
END = np.uint64(0x2545F4914F6CDD1D)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.where((np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def _least(level: int) -> int:
    return math.ceil(BASE ** (level - 1) - 1e-9) if level else 0


#: The least and the middle count of each level.
LEAST = [float(_least(level)) for level in range(LEVELS)]
MIDDLE = [0.0] + [(_least(q) + max(_least(q), _least(q + 1) - 1)) / 2 for q in range(1, LEVELS)]


def levels_of(counts: np.ndarray) -> np.ndarray:
    return (np.floor(np.log(counts) / math.log(BASE) + 1e-9) + 1).astype(np.int64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of the hash."""
    return ((keys >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def _places(keys: np.ndarray, level: int, bits):
    """Bit numbers within a filter of ``bits`` bits (fewer than 2 ** 32), one array per hash function."""
    y = mix(keys + np.uint64(level * 0xD1B54A32D192ED03 % 2**64))
    place, step = y >> np.uint64(32), (y & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    for _ in range(HASHES):
        yield (place * bits >> np.uint64(32)).astype(np.int64)
        place = (place + step) & np.uint64(0xFFFFFFFF)


def fill(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, int]:
    """The packed bits of a part, and their number."""
    size = max(64, int(levels.sum()) * BITS)
    bits = np.zeros(size, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in _places(keys[levels >= level], level, np.uint64(size)):
            bits[place] = 1
    return np.packbits(bits, bitorder="little"), size


def joined(parts: int, found, size: int) -> tuple:
    """The filters ``(part, bits, size)`` of consecutive parts, of ``size`` bits at most, as one; parts that got no keys
    are empty."""
    sizes, starts = np.full(parts, 64, np.uint64), np.zeros(parts, np.int64)
    whole, at = np.zeros(8 + size // 8 + parts, np.uint8), 8
    for part, bits, part_size in found:
        starts[part], sizes[part] = 8 * at, part_size
        whole[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
        at += len(bits)
    return parts, starts, sizes, whole


class Filter:
    """What :func:`joined` put together, to look up levels."""

    def __init__(self, parts: int, starts: np.ndarray, sizes: np.ndarray, bits: np.ndarray):
        self.parts, self.starts, self.sizes, self.bits = parts, starts, sizes, bits

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: probes go on until one is missing."""
        found, alive = np.zeros(len(keys), np.int64), np.arange(len(keys))
        part = part_of(keys, self.parts)
        starts, sizes = self.starts[part], self.sizes[part]
        for level in range(1, LEVELS):
            if not len(alive):
                break
            y = mix(keys[alive] + np.uint64(level * 0xD1B54A32D192ED03 % 2**64))
            place, step = y >> np.uint64(32), (y & np.uint64(0xFFFFFFFF)) | np.uint64(1)
            for _ in range(HASHES):
                bit = starts[alive] + (place * sizes[alive] >> np.uint64(32)).astype(np.int64)
                hit = (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                alive, place, step = alive[hit], place[hit], step[hit]
                place = (place + step) & np.uint64(0xFFFFFFFF)
            found[alive] = level
        return found


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * GOLDEN + words)


def _tokens(column: pa.Array):
    """``(row of each token, its context, the token)``, some texts or a part of a long one at a time."""
    before = END
    for row, whole, data, offsets in text_blocks(column, NO_SPACE, BLOCK_BYTES):
        data = LOWER[data]
        starts, lengths = find_runs(NO_SPACE, data, offsets)
        ends = np.searchsorted(starts, offsets[1:])
        texts = np.arange(len(ends))
        tokens = np.full(len(starts) + len(ends), END)
        rows = row + np.searchsorted(ends + texts, np.arange(len(tokens)))
        there = np.ones(len(tokens), bool)
        there[ends + texts] = False
        tokens[there] = hash_runs(data, starts, lengths)
        if not whole:
            tokens, rows = tokens[:-1], rows[:-1]
        if len(tokens):
            yield rows, np.append(before, tokens[:-1]), tokens
            before = tokens[-1]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, with the sum of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _squeeze(values: np.ndarray) -> bytes:
    """Unsigned numbers by planes of bytes, highest first, of which the higher ones are mostly zeros."""
    width = values.dtype.itemsize
    planes = values.astype(f">u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _stretch(packed: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    values = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T)
    return values.view(f">u{width}")[:, 0].astype(kind)


PACKED = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _pack(keys: np.ndarray, counts: np.ndarray, parts: int, first_part: int, chunk: int = 0):
    """Sorted keys by part, as their differences, with their counts."""
    edges = np.searchsorted(part_of(keys, parts), np.arange(parts + 1))
    rows, held = [], 0
    for part in range(parts):
        own = keys[edges[part] : edges[part + 1]]
        if len(own):
            steps = _squeeze(np.diff(own, prepend=np.uint64(0)))
            rows.append((first_part + part, chunk, steps, _squeeze(counts[edges[part] : edges[part + 1]].astype(np.uint64))))
            held += len(steps) + len(rows[-1][-1])
        if rows and (held >= SENT_BYTES or part == parts - 1):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)
            rows, held = [], 0


def _unpacked(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Keys in order and their counts, row by row."""
    keys = [np.cumsum(_stretch(steps, np.uint64), dtype=np.uint64) for steps in rows.column("keys").to_pylist()]
    return keys, [_stretch(n, np.uint64).astype(np.int64) for n in rows.column("counts").to_pylist()]


def _unpack(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return _summed(*_unpacked(rows))


def _count(parts: int, word_parts: int):
    def run(batches):
        pairs, held, words, n_words = [], 0, [], 0

        def send_pairs():
            yield from _pack(*np.unique(np.concatenate(pairs), return_counts=True), parts, 0)

        for batch in batches:
            for _, before, tokens in _tokens(batch.column(0)):
                pairs.append(pair_keys(before, tokens))
                held += len(tokens)
                words.append(np.unique(tokens, return_counts=True))
                n_words += len(words[-1][0])
                if held >= LOCAL_PAIRS:
                    yield from send_pairs()
                    pairs, held = [], 0
                if n_words >= 2 * LOCAL_WORDS:
                    words = [_summed(*zip(*words))]
                    n_words = len(words[0][0])
                    if n_words >= LOCAL_WORDS:
                        yield from _pack(*words[0], word_parts, parts)
                        words, n_words = [], 0
        if pairs:
            yield from send_pairs()
        if words:
            yield from _pack(*_summed(*zip(*words)), word_parts, parts)

    return run


BUILT = pa.schema(
    [("part", pa.int32()), ("size", pa.int64()), ("bits", pa.binary()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
)


def _build(parts: int):
    """The filter of a part; a part of words also keeps its exact counts."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        keys, counts = _unpack(rows)
        bits, size = fill(keys, levels_of(counts))
        is_words = key[0].as_py() >= parts
        exact = [keys.view(np.int64), counts] if is_words else [[], []]
        columns = [[key[0].as_py()], [size], [bits.tobytes()], [exact[0]], [exact[1]]]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, BUILT)], schema=BUILT)

    return run


def _chunk_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("chunk", pa.int64()), ("words", pa.binary()), ("tokens", pa.binary()), ("row_no", pa.list_(pa.int64())),
            ("doc_id", pa.list_(kind)), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())),
        ]
    )


def _chunks(kind: pa.DataType):
    """Some documents or a part of a long one as distinct words, by their counts and then by hash, and the places of their
    tokens among them, which begin with the context of the first; per document its tokens here."""
    schema = _chunk_schema(kind)

    def run(batches):
        chunk, tokens, held, rows = TaskContext.get().partitionId() << 32, [], 0, []

        def written():
            found, place, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            lists = [pa.concat_arrays(x) for x in zip(*rows)]
            packed = [chunk], [_squeeze(np.diff(found[order], prepend=np.uint64(0)))], [_squeeze(rank[place])]
            columns = [pa.array(c, f.type) for c, f in zip(packed, schema)]
            columns += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for row, before, own in _tokens(batch.column(3)):
                tokens += [own] if tokens else [before[:1], own]
                held += len(own)
                there, n = np.unique(row, return_counts=True)
                rows.append([*(batch.column(i).take(pa.array(there)) for i in range(3)), pa.array(n, pa.int64())])
                if held >= LOCAL_PAIRS:
                    yield written()
                    chunk, tokens, held, rows = chunk + 1, [], 0, []
        if tokens:
            yield written()

    return run


def _places_of(words: bytes, tokens: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: its words, and for each token the places of its context and its own among them."""
    place = _stretch(tokens, np.uint32)
    return np.cumsum(_stretch(words, np.uint64), dtype=np.uint64), place[:-1], place[1:]


def _ask(parts: int, word_parts: int):
    """The distinct pairs and words of each chunk, with their counts in its training documents, which may be 0."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, packed, tokens, held, n = (batch.column(c)[i] for c in range(5))
                words, before, own = _places_of(packed.as_py(), tokens.as_py())
                learned = pa.compute.fill_null(pa.compute.invert(held.values), False).to_numpy(zero_copy_only=False)
                learned = np.repeat(learned, n.values.to_numpy())
                pairs = pair_keys(words[before], words[own])
                order = np.argsort(pairs)
                pairs = pairs[order]
                first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
                counts = np.add.reduceat(learned[order], first, dtype=np.int64)
                yield from _pack(pairs[first], counts, parts, 0, chunk.as_py())
                counts, order = np.bincount(own[learned], minlength=len(words)), np.argsort(words)
                yield from _pack(words[order], counts[order], word_parts, parts, chunk.as_py())

    return run


ANSWERS = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int64()), ("levels", pa.binary()), ("counts", pa.binary()), ("facts", pa.list_(pa.int64()))]
)


def _answer(parts: int):
    """The filter of a part is filled and probed for what each chunk asked; a part of words also returns exact counts,
    and, in a row without chunk, what the model must know of all words: words and their counts by level, words seen once."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        asked, counts = _unpacked(rows)
        keys, counts = _summed(asked, counts)
        seen = counts > 0
        exact = levels_of(counts[seen])
        bits, size = fill(keys[seen], exact)
        levels = Filter(*joined(1, [(0, bits, size)], size)).levels(keys).astype(np.uint8)
        out = []
        for chunk, own in zip(rows.column("chunk").to_pylist(), asked):
            at = np.searchsorted(keys, own)
            out.append([chunk, _squeeze(levels[at]), None, None])
            if key[0].as_py() >= parts:
                out[-1][2] = _squeeze(counts[at].astype(np.uint64))
        if key[0].as_py() >= parts:
            n = np.zeros(LEVELS, np.int64)
            np.add.at(n, exact, counts[seen])
            out.append([None, None, None, [*np.bincount(exact, minlength=LEVELS).tolist(), *n.tolist(), int((counts == 1).sum())]])
        columns = [[key[0].as_py()] * len(out), *zip(*out)]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, ANSWERS)], schema=ANSWERS)

    return run


def _score_chunk(parts: int, facts: dict, kind: pa.DataType):
    schema = pa.schema(
        [
            ("row_no", pa.int64()), ("doc_id", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
            ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
        ]
    )
    middle, least, ceiling = np.asarray(MIDDLE), np.asarray(LEAST), np.power(BASE, np.arange(LEVELS))

    def run(answers: pa.Table, chunk: pa.Table) -> pa.Table:
        words, before, own = _places_of(chunk.column("words")[0].as_py(), chunk.column("tokens")[0].as_py())
        part = answers.column("part").to_numpy()
        of_pairs, of_words = ([int(i) for i in np.argsort(part) if (part[i] >= parts) == which] for which in (False, True))

        def answered(name: str, rows: list[int], kind):
            return np.concatenate([_stretch(answers.column(name)[i].as_py(), kind) for i in rows])

        order = np.argsort(words)
        level, counts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        level[order], counts[order] = answered("levels", of_words, np.uint8), answered("counts", of_words, np.uint64)
        p = np.where(level > 0, (1 - facts["unseen"]) * middle[level] / facts["spread"], facts["unseen"])
        a = np.where(level > 0, TRUST, 0.0)
        head = (counts > 0) & (levels_of(np.maximum(counts, 1)) >= facts["lowest"])
        mass = np.where(head, counts, ceiling[level])
        base = np.log10(counts + 1) - math.log10(facts["total"] + facts["distinct"] + 1)

        pairs = pair_keys(words[before], words[own])
        order = np.argsort(pairs)
        place = np.empty(len(pairs), np.int32)
        pairs = pairs[order]
        place[order] = np.cumsum(np.append(False, pairs[1:] != pairs[:-1]))
        of_pair = answered("levels", of_pairs, np.uint8)[place]
        del pairs, order, place
        value = np.empty(len(own))
        for at in range(0, len(own), STEP):
            here = slice(at, at + STEP)
            h = before[here]
            pair = np.minimum(least[of_pair[here]] / mass[h], 1.0)
            value[here] = np.log10(a[h] * pair + (1 - a[h]) * p[own[here]])
        lists = {name: chunk.column(name).combine_chunks().flatten() for name in ("row_no", "doc_id", "held_out", "n_tokens")}
        starts = np.cumsum(lists["n_tokens"].to_numpy()) - lists["n_tokens"].to_numpy()
        sums = (counts > 0)[own].astype(np.int64), base[own], value
        columns = [*lists.values(), *(pa.array(np.add.reduceat(x, starts)) for x in sums)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _lowest(by_level: dict[int, int]) -> int:
    """The lowest level of the most frequent words, at most ``HEAD``, whose exact counts the model uses."""
    frequent, lowest = 0, LEVELS
    for level in sorted(by_level, reverse=True):
        frequent += by_level[level]
        if frequent > HEAD:
            break
        lowest = level
    return lowest


def _far_scores(rows: DataFrame, parts: int, word_parts: int, id_type: T.DataType) -> DataFrame:
    """Scores by filters that stay in their parts."""
    kind = to_arrow_type(id_type)
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType()),
            T.StructField("row_no", T.ArrayType(T.LongType())), T.StructField("doc_id", T.ArrayType(id_type)),
            T.StructField("held_out", T.ArrayType(T.BooleanType())), T.StructField("n_tokens", T.ArrayType(T.LongType())),
        ]
    )
    chunks = materialise(rows.mapInArrow(_chunks(kind), schema), "lm-chunks")
    asked = chunks.select("chunk", "words", "tokens", "held_out", "n_tokens").mapInArrow(
        _ask(parts, word_parts), "part int, chunk long, keys binary, counts binary"
    )
    answers = materialise(
        asked.groupBy("part").applyInArrow(
            _answer(parts), "part int, chunk long, levels binary, counts binary, facts array<long>"
        ),
        "lm-answers",
    )
    of_all = answers.where("chunk IS NULL").select(F.posexplode("facts").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    found = {row["at"]: row["n"] for row in of_all.collect()}
    words = {q: found[q] for q in range(LEVELS) if found.get(q)}
    total, once = sum(found.get(LEVELS + q, 0) for q in words), found.get(2 * LEVELS, 0)
    facts = {
        "total": total,
        "distinct": sum(words.values()),
        "spread": max(sum(MIDDLE[q] * n for q, n in words.items()), 1.0),
        "unseen": min(0.5, (once + 1) / (total + 1)) if total else 1.0,
        "lowest": _lowest(words),
    }
    out = T.StructType(
        [
            T.StructField("row_no", T.LongType()), T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
            T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
        ]
    )
    given = answers.where("chunk IS NOT NULL").select("part", "chunk", "levels", "counts").groupBy("chunk")
    scored = given.cogroup(chunks.groupBy("chunk")).applyInArrow(_score_chunk(parts, facts, kind), out)
    # A long document may be in several chunks.
    return scored.groupBy("row_no").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("row_no")


def _score(sent, facts: dict, kind: pa.DataType):
    """``sent``: filters of pairs and words, hashes and exact counts of the most frequent words."""
    out = pa.schema(
        [
            ("row_no", pa.int64()), ("doc_id", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
            ("head_known", pa.int64()), ("head_base", pa.float64()), ("score", pa.float64()),
            ("rare", pa.list_(pa.int64())),
        ]
    )
    middle, least, ceiling = np.asarray(MIDDLE), np.asarray(LEAST), np.power(BASE, np.arange(LEVELS))
    unit = math.log10(facts["total"] + facts["distinct"] + 1)

    def run(batches):
        pairs_sent, words_sent, head_keys, head_counts = sent.value
        pair_filter, word_filter = Filter(*pairs_sent), Filter(*words_sent)

        def exact(keys):
            at = np.minimum(np.searchsorted(head_keys, keys), len(head_keys) - 1)
            return np.where(head_keys[at] == keys, head_counts[at], 0) if len(head_keys) else np.zeros(len(keys), np.int64)

        for batch in batches:
            size = batch.num_rows
            n_tokens, known, base, score = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
            rare = []
            for rows, before, tokens in _tokens(batch.column(3)):
                keys, place = np.unique(np.append(before[0], tokens), return_inverse=True)
                counts = exact(keys)
                of_before, of_token = place[:-1], place[1:]
                seen = counts[of_token] > 0
                n_tokens += np.bincount(rows, minlength=size)
                known += np.bincount(rows[seen], minlength=size)
                base += np.bincount(rows[seen], np.log10(counts[of_token[seen]] + 1) - unit, size)
                rare.append((rows[~seen], tokens[~seen]))
                level = word_filter.levels(keys)
                p = np.where(level > 0, (1 - facts["unseen"]) * middle[level] / facts["spread"], facts["unseen"])
                a = np.where(level > 0, TRUST, 0.0)
                mass = np.where(counts > 0, counts, ceiling[level])
                linked = np.flatnonzero(level[of_before] > 0)
                found, at = np.unique(pair_keys(before[linked], tokens[linked]), return_inverse=True)
                pair = np.zeros(len(tokens))
                pair[linked] = least[pair_filter.levels(found)][at] / mass[of_before[linked]]
                value = np.log10(a[of_before] * np.minimum(pair, 1.0) + (1 - a[of_before]) * p[of_token])
                score += np.bincount(rows, value, size)

            def lists(rows, values):
                return pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(rows, np.arange(size + 1)).astype(np.int32)), pa.array(values.view(np.int64))
                )

            columns = [batch.column(0), batch.column(1), batch.column(2), n_tokens, known, base, score]
            columns.append(lists(*(np.concatenate(x) for x in zip(*rare))))
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=out
            )

    return run


def bloom_scores(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    ``held_out`` is a column: rows where it is true are scored but not learned from. Null texts are empty
    and consist of the end mark. Repeated rows are learned from and scored one by one; a null id stays
    null. Long texts are read in blocks. An empty table gives no rows; without training rows every token is
    unknown.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(doc_id).alias("doc_id"),
        held_out.alias("held_out"),
        full_text(text).alias("text"),
    )
    train = rows.where(~F.col("held_out")).select("text")
    chars, documents = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    parts = chars // PART_CHARS + 1
    word_parts = parts // WORD_SHARE + 1
    id_type = docs.schema[doc_id].dataType
    if BITS * (chars + 3 * documents) > MOST_BITS:
        return _far_scores(rows, parts, word_parts, id_type)
    counted = train.mapInArrow(_count(parts, word_parts), "part int, chunk long, keys binary, counts binary")
    built = materialise(
        counted.groupBy("part").applyInArrow(
            _build(parts), "part int, size long, bits binary, keys array<long>, counts array<long>"
        ),
        "lm-filter",
    )
    entry = F.explode(F.arrays_zip("keys", "counts")).alias("entry")
    vocabulary = built.where(F.col("part") >= parts).select(entry).select(
        F.col("entry.keys").alias("key"), F.col("entry.counts").alias("n")
    )
    level = (F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(BASE)) + F.lit(1e-9)) + 1).cast("int")
    by_level = (
        vocabulary.groupBy(level.alias("level"))
        .agg(
            F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")
        )
        .collect()
    )
    total, distinct = sum(r["n"] for r in by_level), sum(r["words"] for r in by_level)
    once = sum(r["once"] for r in by_level)
    is_word = F.col("part") >= parts
    sizes = {row["w"]: row["size"] for row in built.groupBy(is_word.alias("w")).agg(F.sum("size").alias("size")).collect()}
    facts = {
        "total": total,
        "distinct": distinct,
        "spread": max(sum(MIDDLE[r["level"]] * r["words"] for r in by_level), 1.0),
        "unseen": min(0.5, (once + 1) / (total + 1)) if total else 1.0,
    }
    head = vocabulary.where(level >= _lowest({r["level"]: r["words"] for r in by_level})).toArrow()
    keys = head.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    filters = []
    # From a written table, so one partition after another costs little and bounds what the driver holds.
    for words, count in enumerate((parts, word_parts)):
        own = built.where(is_word if words else ~is_word).select("part", "bits", "size").toLocalIterator()
        rows_of = ((row["part"] - words * parts, row["bits"], row["size"]) for row in own)
        filters.append(joined(count, rows_of, sizes.get(bool(words), 0)))
    sent = spark.sparkContext.broadcast((*filters, keys[order], head.column("n").to_numpy()[order]))
    del filters, head

    schema = T.StructType(
        [
            T.StructField("row_no", T.LongType()), T.StructField("doc_id", id_type),
            T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("head_known", T.LongType()), T.StructField("head_base", T.DoubleType()),
            T.StructField("score", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())),
        ]
    )
    scored = materialise(rows.mapInArrow(_score(sent, facts, to_arrow_type(id_type)), schema), "lm-scores")
    rare = (
        scored.select("row_no", F.explode("rare").alias("key"))
        .join(vocabulary, "key", "left")
        .groupBy("row_no")
        .agg(
            F.count("n").alias("rare_known"),
            F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - F.lit(math.log10(total + distinct + 1))).alias("rare_base"),
        )
    )
    return scored.drop("rare").join(rare, "row_no", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op10_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


BOOK = {"op10_bloom_lm": (op10_bloom_lm, None)}
