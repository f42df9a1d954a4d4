"""Suffix automata and the removal of repeated passages, against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanwork.llm import byte_words, repeats

COLUMNS = "doc_id long, text string, id long, words string, spans int, starts int"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(rows, width):
    """Kept words and number of removed ones of each row ``(id, text)``."""
    last = max((i for i, _ in rows if i is not None), default=0) + 1 if not rows or not isinstance(rows[0][0], str) else "\U0010ffff"
    ids = [last if i is None else i for i, _ in rows]
    first = {}
    for i, (_, text) in zip(ids, rows):
        words = split(text)
        for at in range(len(words) - width + 1):
            window = tuple(words[at : at + width])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, (_, text) in zip(ids, rows):
        words, gone = split(text), set()
        for at in range(len(words) - width + 1):
            if first[tuple(words[at : at + width])] < i:
                gone.update(range(at, at + width))
        out.append((" ".join(w for at, w in enumerate(words) if at not in gone), len(gone)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 4))
def test_automaton(texts, width):
    automaton = repeats.SuffixAutomaton()
    for i, text in enumerate(texts):
        automaton.add(text, i)
    automaton.finish()
    for text in [*texts, "abab", "cabb", "aaacbbb"]:
        for at, owner in enumerate(automaton.stream(text, width)):
            piece = text[max(0, at + 1 - width) : at + 1]
            wanted = [i for i, other in enumerate(texts) if piece in other] if len(piece) == width else []
            assert owner == (min(wanted) if wanted else None)


def test_words_of_bytes():
    import pyarrow as pa

    texts = ["one two", "", "three", " \x0bé ü\tx\x1fy ", "one", "a" * 40 + " b", "two  one"]
    data, offsets = byte_words.text_bytes(pa.array(["cut off", *texts]).slice(1))
    starts, lengths = byte_words.find_runs(byte_words.NO_SPACE, data, offsets)
    found = [bytes(data[s : s + n]).decode() for s, n in zip(starts, lengths)]
    wanted = [word for text in texts for word in split(text)]
    assert found == wanted
    hashes = byte_words.hash_runs(data, starts, lengths)
    by_word = {}
    for word, value in zip(wanted, hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)

    def passage(n):
        return [draw.choice("a b c d e f g h i j k l m n o p".split()) + str(draw.randint(0, 9)) for _ in range(n)]

    shared, line = passage(40), passage(13)
    texts = [None, "", " \n\t", "one", " ".join(passage(12)), " ".join(shared)]
    for i in range(30):
        own = passage(draw.randint(0, 60))
        at = draw.randint(0, len(own))
        middle = [shared, shared[3:25], line, shared[20:] + line, []][i % 5]
        texts.append(draw.choice([" ", "\n", "  "]).join(own[:at] + middle + own[at:]))
    texts += [texts[7], " ".join(["again"] * 60), " ".join(["again"] * 40), "  no break  " * 20]
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [(7, texts[7]), (7, texts[12]), (None, texts[9]), (None, texts[9]), (-4, texts[11]), (2**40, texts[6])]


def check(frame, rows, width):
    got = sorted((r.kept, r.n_removed) for r in frame.collect())
    assert got == sorted(brute_force(rows, width))


def test_repeats(spark, rows):
    frame = spark.createDataFrame([(*row, 0, "w", 1, 2) for row in rows], COLUMNS).repartition(3)
    out = repeats.drop_repeats(frame)
    check(out, rows, 13)
    by_id = {r.id: r for r in out.collect()}
    words = split(rows[6][1])
    for r in out.collect():
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed and len(split(r.kept)) == r.n_words - r.n_removed
    assert by_id[2**40].spans[0] == (0, len(words)) and by_id[0].n_words == 0
    check(repeats.drop_repeats(frame, width=5), rows, 5)
    check(repeats.drop_repeats(frame, width=30), rows, 30)


def test_ids_of_text(spark, rows):
    rows = [(None if i is None else f"k{i}", t) for i, t in rows]
    check(repeats.drop_repeats(spark.createDataFrame(rows, "doc_id string, text string")), rows, 13)


def test_heavy_anchors_blocks_and_flushes_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    monkeypatch.setattr(repeats, "LEAST_HEAVY", 2)
    monkeypatch.setattr(repeats, "MOST_HEAVY", 1 << 40)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 100)
    monkeypatch.setattr(repeats, "HELD_SEGMENTS", 20)
    monkeypatch.setattr(repeats, "AUTOMATON_SEGMENTS", 3)
    monkeypatch.setattr(repeats, "SHARD_CHARS", 500)
    check(repeats.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")), rows, 13)


def test_empty_table(spark):
    assert repeats.drop_repeats(spark.createDataFrame([], COLUMNS)).count() == 0


def peak_bytes(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def batches_of(texts):
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int32()), pa.array(texts)]
    return [pa.RecordBatch.from_arrays(columns, names=["id", "mark", "text"])]


class NoHeavy:
    value = np.zeros(0, np.uint64)


def test_memory_of_sent_segments():
    draw = np.random.default_rng(2)
    batches = batches_of([" ".join(map(str, draw.integers(10, 1000, 500).tolist())) for _ in range(2400)])
    rows_of = lambda: [b.num_rows for b in repeats._send_segments(13, 4, NoHeavy)(iter(batches))]
    sent, peak = peak_bytes(rows_of)
    assert sum(sent) > repeats.HELD_SEGMENTS and max(sent) <= repeats.BLOCK_SEGMENTS
    assert peak < 6 * repeats.HELD_SEGMENTS * repeats._row_bytes(8)


def test_memory_of_a_shard_that_repeats_itself(monkeypatch):
    monkeypatch.setattr(repeats, "AUTOMATON_SEGMENTS", 100)
    draw = random.Random(4)
    texts = [" ".join(str(draw.randint(10, 99)) for _ in range(300)) for _ in range(700)]
    twice = batches_of(texts + [f"new {t} end" for t in texts])
    monkeypatch.setattr(repeats, "HELD_SEGMENTS", 1000)
    shard = pa.Table.from_batches(list(repeats._send_segments(13, 1, NoHeavy)(iter(twice))))
    out, peak = peak_bytes(lambda: repeats._read_shard(13, pa.int64())(shard))
    assert out.num_rows > 20_000
    assert peak < 1000 * out.num_rows


def test_an_anchor_of_many_segments_takes_small_automata(monkeypatch):
    monkeypatch.setattr(repeats, "AUTOMATON_SEGMENTS", 50)
    draw = random.Random(5)
    around = lambda: " ".join(str(draw.randint(0, 2)) for _ in range(8))
    texts = [f"{around()} one phrase that all have {around()}" for _ in range(2000)]
    states, finish = [], repeats.SuffixAutomaton.finish
    monkeypatch.setattr(
        repeats.SuffixAutomaton, "finish", lambda self: (states.append(len(self.links)), finish(self))
    )
    shard = pa.Table.from_batches(list(repeats._send_segments(13, 1, NoHeavy)(iter(batches_of(texts)))))
    out = repeats._read_shard(13, pa.int64())(shard)
    assert max(states) <= 2 * 17 * 2 * 50
    words = np.concatenate([split(t) for t in texts])
    first = {}
    for i, text in enumerate(texts):
        for at in range(9):
            first.setdefault(tuple(split(text)[at : at + 13]), i)
    data, offsets = byte_words.text_bytes(pa.array(texts))
    starts, lengths = byte_words.find_runs(byte_words.NO_SPACE, data, offsets)
    hashes, ends = byte_words.hash_runs(data, starts, lengths), np.searchsorted(starts, offsets[1:])
    found = repeats.Segments(hashes, ends, 13, NoHeavy.value)
    marks = repeats.marks(found.packed()[0])[0].tolist()
    firsts = dict(zip(out.column("mark").to_pylist(), out.column("firsts").to_pylist()))
    assert len(firsts) > 1000
    for mark, begin, doc, n in zip(marks, found.begin.tolist(), found.doc.tolist(), (found.left + found.right - 7).tolist()):
        wanted = [first[tuple(words[begin + i : begin + i + 13].tolist())] for i in range(n)]
        assert firsts.get(mark, [doc] * n) == wanted


def test_segments_hold_every_window_once():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 12, 500).astype(np.uint64) * repeats.GOLDEN
    ends = np.asarray([0, 5, 100, 100, 113, 125, 500])
    found = repeats.Segments(words, ends, 13, np.zeros(0, np.uint64))
    windows = [
        (int(doc), int(at + i))
        for doc, at, n in zip(found.doc, found.at, found.left + found.right + repeats.ANCHOR - 12)
        for i in range(n)
    ]
    starts = [0, *ends[:-1].tolist()]
    wanted = [(d, at) for d, (s, e) in enumerate(zip(starts, ends.tolist())) for at in range(e - s - 12)]
    assert sorted(windows) == wanted
