"""Best-fit packing of token sequences, improved by swap-based local search.

Documents become token ids in Arrow batches; only the pieces (id, place, length, checksum) go on. Pieces
are dealt over shards of about ``SHARD`` rows, whatever their ids are. In a shard, bins are filled best fit
in order of the ids. That leaves room in them, so bins that are not full exchange pieces: move, one for one,
two for one, always so that the sum of squared fills grows, until bins run empty and the rest are as
few as the tokens need. Where no step is left before that, the bins with room are poured out with some others, filled
anew and searched again. The least filled bins of all shards are then packed together again, level by level,
until one shard is left, so the number of shards costs no sequences.
"""

from __future__ import annotations

import heapq
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.common import full_text, table, worker_state
from gleanwork.workspace import materialise

CAPACITY = 2048
SHARD = 16384
#: Of the bins of a shard, one in so many (at least one) is packed again on the next level.
LOOSE = 64
#: New beginnings of a search, one after another, that may bring nothing.
PATIENCE = 12
CACHE_WORDS = 800_000
END_ID = 0


class WordIds(dict):
    """The packed ids of a word without white space, found once per worker process.

    The tokenizer cuts at white space and between letters and other characters, so the ids of a text are
    those of its words one after another, and those of letters with punctuation after them can be joined.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(word) > 64:
            return self.encode(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        stem = word.rstrip(".,!?;:#$%&*")
        if stem and stem != word and stem.isalpha() and "\u0130" not in stem:  # it lowers to two characters
            ids = self[stem] + self[word[len(stem) :]]
        elif not word.isalpha() or not unicodedata.is_normalized("NFC", word):
            ids = self.encode(word)
        elif (lower := "".join(map(str.lower, word))) != word:
            ids = self[lower] if lower.isalpha() else self.encode(word)
        else:  # letters in their final form: what is left of the tokenizer's work is the merging
            ((mapped, _),) = self.letters(word)
            ids = np.asarray([token.id for token in self.tokenizer.model.tokenize(mapped)], dtype="<u4").tobytes()
        self[word] = ids
        return ids


#: Blanks of ``str.split`` that the tokenizer takes for ordinary characters.
ODD_BLANKS = "\x1c\x1d\x1e\x1f"


def token_bytes(text: str, words: WordIds) -> bytes:
    if any(mark in text for mark in ODD_BLANKS):
        return words.encode(text)
    return b"".join(map(words.__getitem__, text.split()))


def _piece_rows(path: str, capacity: int, schema: pa.Schema):
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def run(batches):
        state = worker_state()
        words = state.get(("word ids", path))
        if words is None:
            words = state[("word ids", path)] = WordIds(path)
        for batch in batches:
            out: list[tuple] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = token_bytes(text, words) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            rows, piece, start, length, crc = zip(*out) if out else ((),) * 5
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int, doc_id: str, text: str) -> DataFrame:
    kind = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text"))
    return rows.mapInArrow(_piece_rows(path, capacity, to_arrow_schema(schema)), schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions, taken in their order. Each goes where the least room is left."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    for position, length in enumerate(lengths):
        fitting = open_rooms >> length << length
        if fitting:
            left = (fitting & -fitting).bit_length() - 1
            chosen = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
            bins[chosen].append(position)
        else:
            left, chosen = capacity, len(bins)
            bins.append([position])
        left -= length
        if left:
            room[left].append(chosen)
            open_rooms |= 1 << left
    return bins


class _BySize:
    """Ranks of bins by the sizes that they can give; a bit per size that is there."""

    def __init__(self):
        self.mask = 0
        self.times: dict[int, dict[int, int]] = {}
        self.heaps: dict[int, list[int]] = {}

    def add(self, size: int, rank: int) -> None:
        times = self.times.setdefault(size, {})
        times[rank] = times.get(rank, 0) + 1
        if times[rank] == 1:
            heapq.heappush(self.heaps.setdefault(size, []), -rank)
            self.mask |= 1 << size

    def remove(self, size: int, rank: int) -> None:
        times = self.times[size]
        times[rank] -= 1
        if not times[rank]:
            del times[rank]
            if not times:
                self.mask ^= 1 << size

    def last(self, size: int) -> int:
        """The greatest rank that gives this size."""
        heap, times = self.heaps[size], self.times[size]
        while -heap[0] not in times:
            heapq.heappop(heap)
        return -heap[0]

    def longest(self, over: int, upto: int) -> int:
        """The greatest size above ``over`` and not above ``upto`` that is there, or 0."""
        found = (self.mask & ((1 << (upto + 1)) - 1)).bit_length() - 1
        return found if found > over else 0


class _Givers:
    """Bins that pieces can be taken from, with the sizes of their pieces and of all pairs of them.

    A bin holds pieces of at most ``sqrt(2 * capacity)`` different lengths, so its pairs of lengths number
    no more than ``capacity`` and all of them are listed.
    """

    def __init__(self):
        self.held: dict[int, dict[int, list[int]]] = {}
        self.singles, self.pairs = _BySize(), _BySize()

    def put(self, rank: int, length: int, position: int) -> None:
        held = self.held.setdefault(rank, {})
        here = held.get(length)
        if here is None:
            for other in held:
                self.pairs.add(length + other, rank)
            here = held[length] = []
        elif len(here) == 1:
            self.pairs.add(2 * length, rank)
        here.append(position)
        self.singles.add(length, rank)

    def take(self, rank: int, length: int) -> int:
        held = self.held[rank]
        here = held[length]
        position = here.pop()
        self.singles.remove(length, rank)
        if not here:
            del held[length]
            for other in held:
                self.pairs.remove(length + other, rank)
        elif len(here) == 1:
            self.pairs.remove(2 * length, rank)
        return position

    def withdraw(self, rank: int) -> dict[int, list[int]]:
        """All pieces of a bin, by length; it gives no more."""
        held = self.held.get(rank, {})
        return {length: [self.take(rank, length) for _ in range(len(held[length]))] for length in list(held)}

    def pair(self, rank: int, size: int) -> tuple[int, int]:
        """Two lengths of a bin that make up ``size``."""
        held = self.held[rank]
        for length in held:
            other = size - length
            if len(held.get(other, ())) > (other == length):
                return length, other
        raise KeyError(size)



def _best_step(givers: _Givers, own, fill, order, receiver: int, gap: int):
    """``kind, gain, rank, taken, given`` of the step that adds most, at most ``gap``; None if no step is better.

    Of the bins that could give, the emptiest does.
    """
    options = []
    if size := givers.singles.longest(0, gap):
        options.append((-size, "move", size, 0))
    for given in own:
        if size := givers.singles.longest(given, given + gap):
            options.append((given - size, "one for one", size, given))
        if size := givers.pairs.longest(given, given + gap):
            options.append((given - size, "two for one", size, given))
    for loss, kind, size, given in sorted(options):
        rank = (givers.pairs if kind == "two for one" else givers.singles).last(size)
        if fill[receiver] - loss > fill[order[rank]]:
            taken = givers.pair(rank, size) if kind == "two for one" else (size,)
            return kind, -loss, rank, taken, given
    return None


def local_search(
    bins: list[list[int]], lengths: list[int], capacity: int, steps: Counter | None = None
) -> list[list[int]]:
    """Exchange pieces between bins that are not full until no more can run empty or nothing improves.

    Bins receive in order of their fill. Each takes, as long as there is one, the step that adds most to it:
    a piece, a piece for one of its own, or two pieces of a bin for one of its own. A step counts only if the
    sum of squared fills grows, so the search ends. ``steps`` counts them by kind.
    """
    steps = Counter() if steps is None else steps
    bins = list(bins)
    fill = [sum(lengths[p] for p in members) for members in bins]
    needed = -(-sum(fill) // capacity)
    improved = True
    while improved and sum(1 for f in fill if f) > needed:
        improved = False
        order = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: (-fill[b], b))
        givers = _Givers()
        for rank, b in enumerate(order):
            for position in bins[b]:
                givers.put(rank, lengths[position], position)
        for rank, receiver in enumerate(order):
            own = givers.withdraw(rank)
            while own and (gap := capacity - fill[receiver]):
                step = _best_step(givers, own, fill, order, receiver, gap)
                if step is None:
                    break
                kind, gain, giver, taken, given = step
                for length in taken:
                    own.setdefault(length, []).append(givers.take(giver, length))
                if given:
                    givers.put(giver, given, own[given].pop())
                    if not own[given]:
                        del own[given]
                fill[receiver] += gain
                fill[order[giver]] -= gain
                steps[kind] += 1
                improved = True
            bins[receiver] = [p for positions in own.values() for p in positions]
    return [members for members in bins if members]


def search_again(
    bins: list[list[int]], lengths: list[int], capacity: int, patience: int = PATIENCE, steps: Counter | None = None
) -> list[list[int]]:
    """Local search, begun anew from where it ended until ``patience`` beginnings in a row bring nothing.

    Bins that are not full, with three times as many others (at random, with a fixed seed), are poured out and
    packed best fit, longest first; the search goes on from there. It counts if there are then fewer bins, or as
    many with greater squares.
    """
    draw = random.Random(len(lengths))
    needed = -(-sum(lengths) // capacity)
    bins = local_search(bins, lengths, capacity, steps)
    failed = 0

    def worth(some):
        return -len(some), sum(sum(lengths[p] for p in members) ** 2 for members in some)

    while len(bins) > needed and failed < patience:
        draw.shuffle(bins)
        full = [sum(lengths[p] for p in members) == capacity for members in bins]
        bins = [b for b, f in zip(bins, full) if not f] + [b for b, f in zip(bins, full) if f]
        some = 4 * max(4, len(full) - sum(full))
        poured, rest = bins[:some], bins[some:]
        positions = sorted((p for members in poured for p in members), key=lambda p: (-lengths[p], p))
        again = best_fit([lengths[p] for p in positions], capacity)
        found = local_search([[positions[i] for i in members] for members in again], lengths, capacity, steps)
        failed = 0 if worth(found) > worth(poured) else failed + 1
        bins = rest + (found if not failed else poured)
    return bins


def _pack_shard(capacity: int, level: int, last: bool):
    def run(key: tuple, pieces: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        pieces = pieces.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = pieces.column("length").to_pylist()
        bins = search_again(best_fit(lengths, capacity), lengths, capacity)
        fill = [sum(lengths[p] for p in members) for members in bins]
        loose: set[int] = set()
        if not last:
            emptiest = sorted(range(len(bins)), key=lambda b: (fill[b], b))[: max(1, len(bins) // LOOSE)]
            loose = {b for b in emptiest if fill[b] < capacity}
        n = len(lengths)
        sequence, offset, again = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        for number, members in enumerate(bins):
            at = 0
            for position in members:
                sequence[position], offset[position] = (level << 56) | (shard << 24) | number, at
                again[position] = number in loose
                at += lengths[position]
        kept = pieces.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return (
            kept.append_column("sequence_id", pa.array(sequence))
            .append_column("offset", pa.array(offset))
            .append_column("loose", pa.array(again))
        )

    return run


def pack_sequences(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    A null or empty text is its end mark alone. Only documents longer than ``capacity`` are cut, into
    pieces of ``capacity`` tokens and a rest. Repeated rows are packed one by one, a null id stays null,
    an empty table gives no rows. Within a sequence offsets follow each other without a gap from 0.
    """
    loose = materialise(token_pieces(docs, tokenizer, capacity, doc_id, text), "pack-pieces")
    packed, level = None, 0
    while True:
        shards = max(1, -(-loose.count() // SHARD))
        dealt = loose.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
        schema = T.StructType(
            loose.schema.fields[:5]
            + [
                T.StructField("sequence_id", T.LongType()),
                T.StructField("offset", T.LongType()),
                T.StructField("loose", T.BooleanType()),
            ]
        )
        done = dealt.groupBy("shard").applyInArrow(_pack_shard(capacity, level, shards == 1), schema)
        done = materialise(done, "pack-level")
        settled = done.where(~F.col("loose")).drop("loose")
        packed = settled if packed is None else packed.unionByName(settled)
        if shards == 1:
            return packed
        loose = done.where("loose").select(*loose.columns)
        level += 1


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_sequences(table(spark, sf_dir, "documents"), path)


BOOK = {"op1_best_fit_packing": (op1_best_fit_packing, None)}
