"""Passages that repeat an earlier document, by suffix automata of reference shards.

A window is ``width`` consecutive words of one document. Windows are dealt to shards by their anchor, the
``ANCHOR`` consecutive words inside them with the least hash, so equal windows meet in one shard. Neighbouring
windows with one anchor travel together as a segment: the anchor and the words around it. A shard builds
suffix automata of its segments, each state knowing the least document that has its words, and streams the
segments through them: where the matching statistic reaches the width, the state tells the first document of
the window. Documents then lose the words of all windows that an earlier document has.

The references are the corpus itself, so no bound holds for what a broadcast of all shards would take, and each of
them would have to meet each document; here a segment meets only the shard of its anchor. Segments that a
task sees twice are sent once. An anchor that very many segments share (a phrase at the edge of which texts
differ) would fill one shard: such anchors, at most ``MOST_HEAVY``, are counted first and sent to the tasks,
and their windows are dealt one by one.

Anchors and the words around them are told apart by 40 bits each, so windows that differ in one word are taken for
equal with a chance of one in 10 ** 12, and others with a smaller one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.byte_words import NO_SPACE, find_runs, hash_runs, pack, slices, text_bytes
from gleanwork.llm.common import full_text, split_words, table
from gleanwork.llm.shingles import mix
from gleanwork.workspace import materialise

WIDTH = 13
ANCHOR = 5
WORD_BYTES = 5
#: Anchors with at least so many segments are heavy, by an estimate from every ``SAMPLE``-th text; the list of them
#: has ``MOST_HEAVY`` entries at most. It steers the work, not the results.
LEAST_HEAVY = 4096
MOST_HEAVY = 1 << 20
SAMPLE = 16
#: Sizes of work, not limits: characters of a shard, bytes of text and segments held at once, segments packed, sent or
#: read at once, segments of an automaton.
SHARD_CHARS = 4 << 20
CHUNK_BYTES = 2 << 20
HELD_SEGMENTS = 200_000
BLOCK_SEGMENTS = 16_384
AUTOMATON_SEGMENTS = 4000
#: Where a packed segment has the numbers of words before and after its anchor, and its words.
LEFT, RIGHT, HEAD = WORD_BYTES, WORD_BYTES + 1, WORD_BYTES + 2
GOLDEN, ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class SuffixAutomaton:
    """A suffix automaton of many sequences; each state knows the least owner of its words."""

    def __init__(self):
        self.arcs: list[dict] = [{}]
        self.links = [-1]
        self.lengths = [0]
        self.owners: list = [None]

    def _state(self, length: int, link: int, arcs: dict, owner) -> int:
        self.arcs.append(arcs)
        self.links.append(link)
        self.lengths.append(length)
        self.owners.append(owner)
        return len(self.links) - 1

    def _split(self, state: int, through: int, symbol) -> int:
        """A copy of ``through`` for the words that reach it by way of ``state``."""
        arcs, links = self.arcs, self.links
        copy = self._state(self.lengths[state] + 1, links[through], dict(arcs[through]), self.owners[through])
        while state >= 0 and arcs[state].get(symbol) == through:
            arcs[state][symbol] = copy
            state = links[state]
        links[through] = copy
        return copy

    def add(self, symbols, owner) -> None:
        arcs, links, lengths, owners = self.arcs, self.links, self.lengths, self.owners
        last = 0
        for symbol in symbols:
            following = arcs[last].get(symbol)
            if following is not None:
                last = following if lengths[following] == lengths[last] + 1 else self._split(last, following, symbol)
            else:
                fresh = self._state(lengths[last] + 1, 0, {}, None)
                state = last
                while state >= 0 and symbol not in arcs[state]:
                    arcs[state][symbol] = fresh
                    state = links[state]
                if state >= 0:
                    through = arcs[state][symbol]
                    right = lengths[through] == lengths[state] + 1
                    links[fresh] = through if right else self._split(state, through, symbol)
                last = fresh
            if owners[last] is None or owner < owners[last]:
                owners[last] = owner

    def finish(self) -> None:
        """Pass the owners on: the words of a state end wherever those of the states that link to it end."""
        owners, links = self.owners, self.links
        for state in sorted(range(1, len(links)), key=self.lengths.__getitem__, reverse=True):
            above, owner = links[state], owners[state]
            if owner is not None and (owners[above] is None or owner < owners[above]):
                owners[above] = owner

    def stream(self, symbols, width: int) -> list:
        """At each symbol the least owner of the last ``width`` symbols, or None where nobody has them."""
        arcs, links, lengths, owners = self.arcs, self.links, self.lengths, self.owners
        state, length, found = 0, 0, []
        for symbol in symbols:
            while state > 0 and symbol not in arcs[state]:
                state = links[state]
                length = lengths[state]
            if symbol in arcs[state]:
                state, length = arcs[state][symbol], length + 1
            if length < width:
                found.append(None)
                continue
            while lengths[links[state]] >= width:
                state = links[state]
                length = lengths[state]
            found.append(owners[state])
        return found


class Segments:
    """The segments of a run of hashed words: anchor, place of the first window, words around the anchor."""

    def __init__(self, words: np.ndarray, ends: np.ndarray, width: int, heavy: np.ndarray):
        self.words, self.around = words, width - ANCHOR
        places = max(0, len(words) - width + 1)
        grams = np.zeros(max(0, len(words) - ANCHOR + 1), np.uint64)
        for i in range(ANCHOR):
            grams = grams * GOLDEN + words[i : i + len(grams)]
        grams = mix(grams)
        least, offset = grams[:places].copy(), np.zeros(places, np.uint8)
        for i in range(1, self.around + 1):
            beside = grams[i : i + places]
            offset[beside < least] = i
            np.minimum(least, beside, out=least)
        starts = np.append(0, ends[:-1])
        whole = np.zeros(places + 1, np.int64)  # windows that end within their text
        np.add.at(whole, np.minimum(starts, places), 1)
        np.add.at(whole, np.minimum(np.maximum(ends - width + 1, starts), places), -1)
        windows = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
        least, anchor = least[windows], windows + offset[windows]
        fresh = np.ones(len(windows), bool)
        fresh[1:] = anchor[1:] != anchor[:-1]
        is_heavy = np.zeros(len(windows), bool)
        if len(heavy):
            is_heavy = heavy[np.minimum(np.searchsorted(heavy, least), len(heavy) - 1)] == least
            fresh |= is_heavy
        first = np.flatnonzero(fresh)
        self.heavy, self.anchors, self.begin = is_heavy[first], least[first], windows[first]
        self.left = anchor[first] - self.begin
        self.right = np.diff(np.append(first, len(windows))) + width - 1 - ANCHOR - self.left
        self.doc = np.searchsorted(ends, self.begin, "right")
        self.at = self.begin - starts[self.doc]

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchor, number of words before it, number after it, and those words: a padded row each, and its length."""
        slots, many = np.arange(2 * self.around), self.left + self.right
        parts = np.zeros((len(self.words) + 1, WORD_BYTES), np.uint8)
        parts[:-1] = self.words.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
        rows = np.zeros((len(self.begin), _row_bytes(self.around)), np.uint8)
        rows[:, :WORD_BYTES] = self.anchors.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
        rows[:, LEFT], rows[:, RIGHT] = self.left, self.right
        for here in _blocks(len(rows)):
            place = self.begin[here, None] + slots + ANCHOR * (slots >= self.left[here, None])
            place = np.where(slots < many[here, None], place, len(self.words))  # a word of zeros
            rows[here, HEAD : HEAD + len(slots) * WORD_BYTES] = parts[place].reshape(len(place), -1)
        return rows, HEAD + WORD_BYTES * many


def _row_bytes(around: int) -> int:
    return -(-(HEAD + 2 * around * WORD_BYTES) // 8) * 8


def _blocks(rows: int) -> list[slice]:
    """Some rows at a time: places of their single bytes take eight times the rows."""
    return [slice(at, at + BLOCK_SEGMENTS) for at in range(0, rows, BLOCK_SEGMENTS)]


def marks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 further bits that tell padded rows apart."""
    total, other = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
    for column in np.ascontiguousarray(rows.view("<u8").T):
        total = (total ^ column) * GOLDEN
        total ^= total >> np.uint64(29)
        other = (other + column) * ODD
        other ^= other >> np.uint64(32)
    return mix(total).view(np.int64), (mix(other) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _chunks(batches, width: int):
    """Row numbers of a batch with its columns, begins, hashed words and ends, some texts at a time.

    A long text is cut into blocks that overlap by one word less than a window.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        data, offsets = text_bytes(batch.column(2))
        for row, end in slices(offsets, CHUNK_BYTES):
            part, own = data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            starts, lengths = find_runs(NO_SPACE, part, own)
            words, ends = hash_runs(part, starts, lengths), np.searchsorted(starts, own[1:])
            step = CHUNK_BYTES // 4 if end - row == 1 else max(1, len(words))
            for begin in range(0, max(1, len(words) - width + 1), step):
                block = words[begin : begin + step + width - 1]
                here = ends if end - row > 1 else np.asarray([len(block)])
                yield ids[row:end], texts[row:end], begin, block, here


def _sample_anchors(width: int):
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])
    none = np.zeros(0, np.uint64)

    def run(batches):
        for _, _, _, words, ends in _chunks(batches, width):
            anchors, n = np.unique(Segments(words, ends, width, none).anchors, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(n)], schema=schema)

    return run


def _with_ids(rows: np.ndarray, lengths: np.ndarray, ids: np.ndarray, many: np.ndarray) -> pa.Array:
    """One value per segment, as that takes less room than columns: its packed row, then its id without leading zeros.

    The number of words after the anchor has 128 more if another id has the segment too.
    """
    rows = rows.copy()
    rows[:, RIGHT] += many.astype(np.uint8) << 7
    if ids.dtype == object:
        return pa.array([r[:n].tobytes() + i.encode() for r, n, i in zip(rows, lengths.tolist(), ids.tolist())], pa.binary())
    ends = ids.astype(">i8").view(np.uint8).reshape(-1, 8)
    fill = np.logical_or.accumulate(ends > 0, axis=1)
    inside = np.concatenate([np.arange(rows.shape[1]) < lengths[:, None], fill], axis=1)
    data = np.concatenate([rows, ends], axis=1)[inside]
    offsets = np.append(0, np.cumsum(inside.sum(axis=1))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _combined(mark: np.ndarray, check: np.ndarray, ids: np.ndarray, many: np.ndarray) -> tuple:
    """Rows with equal marks once: where the row is, the least id, and whether another id has it."""
    order = np.argsort(mark)
    mark, check, least = mark[order], check[order], ids[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (mark[1:] != mark[:-1]) | (check[1:] != check[:-1])
    first = np.flatnonzero(fresh)
    lowest, highest = np.minimum.reduceat(least, first), np.maximum.reduceat(least, first)
    more = np.logical_or.reduceat(many[order], first) | (lowest != highest).astype(bool)
    return order[first], lowest, more


def _send_segments(width: int, shards: int, heavy):
    """The segments of a task with their shards, least ids, and whether another id has them too."""
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.binary())])

    def batches_of(parts):
        mark, check, rows, lengths, key, ids, many = (np.concatenate(column) for column in zip(*parts))
        parts.clear()
        chosen, least, many = _combined(mark, check, ids, many)
        for here in _blocks(len(chosen)):
            at = chosen[here]
            shard = pa.array((key[at] % np.uint64(shards)).astype(np.int32))
            segment = _with_ids(rows[at], lengths[at], least[here], many[here])
            yield pa.RecordBatch.from_arrays([shard, segment], schema=schema)

    def run(batches):
        parts, held = [], 0
        for ids, _, _, words, ends in _chunks(batches, width):
            found = Segments(words, ends, width, heavy.value)
            if not len(found.begin):
                continue
            rows, lengths = found.packed()
            mark, check = marks(rows)
            key = np.where(found.heavy, mark.view(np.uint64), found.anchors)
            chosen, least, many = _combined(mark, check, ids[found.doc], np.zeros(len(mark), bool))
            parts.append((*(column[chosen] for column in (mark, check, rows, lengths, key)), least, many))
            held += len(chosen)
            if held >= HELD_SEGMENTS:
                del found, rows
                yield from batches_of(parts)
                held = 0
        if parts:
            yield from batches_of(parts)

    return run


def _send_places(width: int, heavy, kind: pa.DataType):
    """The marks of each segment with its text and the place of its first window."""
    schema = pa.schema(
        [("mark", pa.int64()), ("check", pa.int32()), ("id", kind), ("text_mark", pa.int32()), ("at", pa.int64())]
    )

    def run(batches):
        for ids, texts, begin, words, ends in _chunks(batches, width):
            found = Segments(words, ends, width, heavy.value)
            if not len(found.begin):
                continue
            mark, check = marks(found.packed()[0])
            columns = [mark, check, ids[found.doc], texts[found.doc], found.at + begin]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _sequences(rows: np.ndarray, around: int) -> list[list[int]]:
    """The words of each segment, its anchor as one symbol between them, as small numbers."""
    left, right = rows[:, LEFT].astype(np.int64), rows[:, RIGHT].astype(np.int64)
    slots = np.arange(2 * around)
    wide = np.zeros((len(rows), 1 + 2 * around, 8), np.uint8)
    wide[:, 0, :WORD_BYTES] = rows[:, :WORD_BYTES]
    wide[:, 1:, :WORD_BYTES] = rows[:, HEAD : HEAD + 2 * around * WORD_BYTES].reshape(len(rows), -1, WORD_BYTES)
    words = wide.view("<u8")[:, :, 0]
    _, codes = np.unique(words[:, 1:][slots < (left + right)[:, None]], return_inverse=True)
    _, anchors = np.unique(words[:, 0], return_inverse=True)
    codes, anchors, at, sequences = codes.tolist(), (-1 - anchors).tolist(), 0, []
    for before, after, anchor in zip(left.tolist(), right.tolist(), anchors):
        end = at + before + after
        sequences.append([*codes[at : at + before], anchor, *codes[at + before : end]])
        at = end
    return sequences


def _through_automaton(rows: np.ndarray, owners: list, around: int) -> list[list]:
    """The first owners of the windows of each segment, by one automaton of them all."""
    sequences, automaton = _sequences(rows, around), SuffixAutomaton()
    for sequence, owner in zip(sequences, owners):
        automaton.add(sequence, owner)
    automaton.finish()
    return [automaton.stream(sequence, around + 1)[around:] for sequence in sequences]


def _through_automata(rows: np.ndarray, ids: np.ndarray, around: int) -> list[list]:
    """The same by windows, for more segments than an automaton should have: equal windows once, some at a time.

    A window that one segment alone has is first there.
    """
    left, many = rows[:, LEFT].astype(np.int64), rows[:, LEFT].astype(np.int64) + rows[:, RIGHT] - around + 1
    segment, ends = np.repeat(np.arange(len(rows)), many), np.cumsum(many)
    skip = np.arange(len(segment)) - np.repeat(ends - many, many)
    windows = np.zeros((len(segment), rows.shape[1]), np.uint8)
    windows[:, :WORD_BYTES] = rows[segment, :WORD_BYTES]
    windows[:, LEFT] = left[segment] - skip
    windows[:, RIGHT] = around - windows[:, LEFT]
    for here in _blocks(len(segment)):
        place = HEAD + WORD_BYTES * skip[here, None] + np.arange(WORD_BYTES * around)
        windows[here, HEAD : HEAD + WORD_BYTES * around] = rows[segment[here, None], place]
    # Numbers of the windows in the order of their bytes.
    parts = windows.view("<u8").T
    order = np.lexsort(parts)
    fresh = np.arange(len(order)) == 0
    for part in parts:
        fresh[1:] |= part[order[1:]] != part[order[:-1]]
    first, number = np.flatnonzero(fresh), np.zeros(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    chosen, least = order[first], np.minimum.reduceat(ids[segment[order]], first)
    firsts, shared = least.tolist(), np.flatnonzero(np.diff(np.append(first, len(order))) > 1)
    for at in range(0, len(shared), AUTOMATON_SEGMENTS):
        here = shared[at : at + AUTOMATON_SEGMENTS]
        for i, (owner,) in zip(here.tolist(), _through_automaton(windows[chosen[here]], least[here].tolist(), around)):
            firsts[i] = owner
    return [[firsts[i] for i in part.tolist()] for part in np.split(number, ends[:-1])]


def _read_shard(width: int, kind: pa.DataType):
    """The first owners of the windows of each segment that some document has to lose words for."""
    around = width - ANCHOR
    schema = pa.schema([("mark", pa.int64()), ("check", pa.int32()), ("firsts", pa.list_(kind))])

    def run(table: pa.Table) -> pa.Table:
        _, offsets, data = table.column("segment").combine_chunks().buffers()
        offsets = np.frombuffer(offsets, np.int32)[: table.num_rows + 1].astype(np.int64)
        data, starts = np.frombuffer(data, np.uint8), offsets[:-1]
        many = data[starts + RIGHT] > 127
        lengths = HEAD + WORD_BYTES * (data[starts + LEFT].astype(np.int64) + (data[starts + RIGHT] & 127))
        anchor = pack(data, starts, np.full(len(starts), WORD_BYTES), 1)[0]
        _, anchor, n = np.unique(anchor, return_inverse=True, return_counts=True)
        # A segment alone with its anchor, in one document, has no window that another document has.
        shared = n > 1
        shared[anchor[many]] = True
        chosen = np.flatnonzero(shared[anchor])
        rows = np.zeros((len(chosen), _row_bytes(around)), np.uint8)
        for here in _blocks(len(chosen)):
            inside = np.arange(rows.shape[1]) < lengths[chosen[here], None]
            rows[here][inside] = data[(starts[chosen[here], None] + np.arange(rows.shape[1]))[inside]]
        rows[:, RIGHT] &= 127
        mark, check = marks(rows)
        begins, ends = (starts + lengths)[chosen], offsets[1:][chosen]
        if pa.types.is_integer(kind):
            sizes = ends - begins
            shift = (4 * (8 - sizes)).astype(np.uint64)
            ids = ((pack(data, begins, sizes, 1)[0] >> shift) >> shift).view(np.int64)
        else:
            ids = np.asarray([data[b:e].tobytes().decode() for b, e in zip(begins, ends)], object)
        order = anchor[chosen]
        chosen, ids, many = _combined(mark, check, ids, many[chosen])
        mark, check, rows, order = mark[chosen], check[chosen], rows[chosen], order[chosen]
        by_anchor = np.argsort(order, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(order[by_anchor], prepend=-1)), len(order))
        kept, found, at = [], [], 0
        while at < len(order):
            # Segments with one anchor stay together.
            end = int(edges[np.searchsorted(edges, min(len(order), at + AUTOMATON_SEGMENTS))])
            here = by_anchor[at:end]
            owners = ids[here].tolist()
            if end - at > 2 * AUTOMATON_SEGMENTS:  # an anchor that very many segments have
                read = _through_automata(rows[here], ids[here], around)
            else:
                read = _through_automaton(rows[here], owners, around)
            for number, firsts, owner, more in zip(here.tolist(), read, owners, many[here].tolist()):
                if more or min(firsts) < owner:
                    kept.append(number)
                    found.append(firsts)
            at = end
        columns = [mark[kept], check[kept], found]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _removed(starts: list[int] | None, width: int, size: int) -> np.ndarray:
    """Which of ``size`` words the windows at ``starts`` cover."""
    edges = np.zeros(size + 1, np.int64)
    if starts:
        places = np.unique(np.asarray(starts, np.int64))
        edges[places] += 1
        np.add.at(edges, places + width, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(width: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            texts, sizes, gone, spans = [], [], [], []
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = split_words(text)
                removed = _removed(starts, width, len(words))
                border = np.flatnonzero(np.diff(np.concatenate([[0], removed.astype(np.int8), [0]])))
                texts.append(" ".join(word for word, out in zip(words, removed.tolist()) if not out))
                sizes.append(len(words))
                gone.append(int(removed.sum()))
                spans.append([{"begin": int(b), "end": int(e)} for b, e in border.reshape(-1, 2)])
            columns = [batch.column(0), pa.array(texts), pa.array(sizes), pa.array(gone), pa.array(spans)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _order_id(docs: DataFrame, doc_id: str) -> tuple[Column, str]:
    """Ids as they compare: whole numbers as such, all others as text; null comes last."""
    if isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        return F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)), "long"
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("\U0010ffff")), "string"


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``id, kept, n_words, n_removed, spans`` per row: the text without the words that an earlier document has.

    A word goes if a window of ``width`` words that covers it also starts in a document with a smaller id. Words are
    separated by blanks and taken as they are; what stays is joined by single blanks; ``spans`` are the
    ranges of words that went. Null texts have no words, and texts shorter than a window lose none. Null ids
    come last. Rows of one id don't take words from each other, repeated rows get equal results. Texts are
    read whole; long ones are worked on in overlapping blocks. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

    if not ANCHOR <= width <= ANCHOR + 127:
        raise ValueError(f"a window has {ANCHOR} to {ANCHOR + 127} words")
    spark = docs.sparkSession
    order_id, kind = _order_id(docs, doc_id)
    rows = docs.select(
        F.col(doc_id).alias("id"), order_id.alias("order_id"), full_text(text).alias("text"),
        F.hash(full_text(text)).alias("text_mark"),
    )
    source = rows.select("order_id", "text_mark", "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = chars // SHARD_CHARS + 1
    sample = source.where(F.pmod(F.xxhash64("order_id"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(_sample_anchors(width), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    # There are fewer segments than characters, so fewer heavy anchors than this divisor.
    found = counts.where(F.col("n") * SAMPLE >= max(LEAST_HEAVY, SAMPLE * chars // MOST_HEAVY)).select("anchor").collect()
    heavy = np.sort(np.asarray([row["anchor"] for row in found], np.int64).view(np.uint64))
    sent = spark.sparkContext.broadcast(heavy)
    id_type = to_arrow_type(T.LongType() if kind == "long" else T.StringType())

    segments = source.mapInArrow(_send_segments(width, shards, sent), "shard int, segment binary")
    firsts = materialise(
        segments.groupBy("shard").applyInArrow(_read_shard(width, id_type), f"mark long, check int, firsts array<{kind}>"),
        "repeat-firsts",
    )
    places = source.mapInArrow(
        _send_places(width, sent, id_type), f"mark long, check int, id {kind}, text_mark int, at long"
    )
    earlier = F.filter(
        F.transform("firsts", lambda first, i: F.when(first < F.col("id"), F.col("at") + i)), lambda at: at.isNotNull()
    )
    hits = materialise(
        places.join(firsts, ["mark", "check"])
        .select(F.col("id").alias("order_id"), "text_mark", earlier.alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("order_id", "text_mark")
        .agg(F.flatten(F.collect_list("starts")).alias("starts")),
        "repeat-hits",
    )
    schema = T.StructType(
        [T.StructField("id", docs.schema[doc_id].dataType)]
        + list(T.StructType.fromDDL("kept string, n_words long, n_removed long, spans array<struct<begin:long,end:long>>"))
    )
    marked = rows.join(hits, ["order_id", "text_mark"], "left").select("id", "text", "starts")
    return marked.mapInArrow(_cut(width, to_arrow_schema(schema)), schema)


def op11_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT row_no, doc_id, place, array_to_string(words[place : place + 12], ' ') AS body
  FROM (SELECT row_no, doc_id, words, unnest(generate_series(1, len(words) - 12)) AS place FROM texts)
), firsts AS (
  SELECT body, min(doc_id) AS first FROM windows GROUP BY body
), gone AS (
  SELECT DISTINCT row_no, unnest(generate_series(place, place + 12)) AS place
  FROM windows JOIN firsts USING (body) WHERE first < doc_id
), lists AS (
  SELECT row_no, list(place) AS gone_at FROM gone GROUP BY row_no
), kept AS (
  SELECT doc_id, len(words) AS n_words, len(coalesce(gone_at, [])) AS n_removed,
         list_filter(words, lambda word, i: NOT list_contains(coalesce(gone_at, []), i)) AS rest
  FROM texts LEFT JOIN lists USING (row_no)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept
"""

BOOK = {"op11_suffix_automata": (op11_suffix_automata, SQL)}
