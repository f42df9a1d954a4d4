"""The operators on small tables with odd rows, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanwork.llm import bloom_lm, fingerprints, mixing, ngram_join, packing, page_text, quality, shingles, toxicity
from gleanwork.llm.common import crc_mod
from gleanwork.llm.exact_dedup import content_sort, exact_dedup

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, `level` int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    base = sentence(draw, 60)
    near = base.replace(base.split()[30], "changed", 1)
    texts = [None, "", " \n", "one", "One", "two words", base, base, near, "x" * 5000, sentence(draw, 6000), "é ñ ü! ß", "a b"]
    texts += [sentence(draw, draw.randint(1, 80)) for _ in range(20)]
    out = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", 1, "r", 2, 3) for i, t in enumerate(texts)]
    return out + [(6, base, "en", "s0", 1, "r", 2, 3), (None, base, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3).checkpoint()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_content_sort(docs, rows, nothing):
    out = content_sort(docs).select("row.doc_id", "keep_id", "group_size", "kept", "body").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    for r in out:
        ids = groups[r.body]
        assert (r.keep_id, r.group_size) == (max(i for i in ids if i is not None), len(ids))
    assert sum(r.kept for r in out) == len(groups) and len(out) == len(rows)
    stay = exact_dedup(docs)
    assert stay.columns == docs.columns and stay.count() == len(groups)
    assert stay.where("text IS NULL OR text = ''").count() == 1
    assert exact_dedup(nothing).count() == 0


def test_hot_texts_are_split_and_counted(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    out = content_sort(frame).select("row.doc_id", "keep_id", "group_size", "kept").collect()
    assert {(r.keep_id, r.group_size) for r in out} == {(2999, 3000)}
    assert [r.doc_id for r in out if r.kept] == [2999]


def test_packing(docs, rows, nothing):
    out = packing.pack_sequences(docs, PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.asarray(ids[at : at + 2048], "<u4").tobytes()
            want[(r[0], piece, at, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == math.ceil(sum(r.length for r in out) / 2048)
    assert packing.pack_sequences(nothing, PATH).count() == 0


def test_local_search_keeps_pieces_and_never_adds_bins():
    for seed in range(60):
        draw = random.Random(seed)
        low = draw.randint(1, 100)
        lengths = sorted((draw.randint(low, 100) for _ in range(draw.choice([3, 40, 400]))), reverse=True)
        first = packing.best_fit(lengths, 100)
        bins = packing.local_search([b[:] for b in first], lengths, 100)
        assert sorted(sum(bins, [])) == list(range(len(lengths))) and len(bins) <= len(first)
        assert max(sum(lengths[p] for p in b) for b in bins) <= 100
    lengths = [60, 60, 50, 50, 40, 40]
    assert len(packing.local_search([[0, 4], [1, 5], [2], [3]], lengths, 100)) == 3


def test_search_empties_bins_of_hard_lengths():
    for low, high in ((500, 900), (300, 1100), (1, 2048), (1, 60)):
        draw = random.Random(low)
        lengths = [draw.randint(low, high) for _ in range(2000)]
        first = packing.best_fit(lengths, 2048)
        steps = Counter()
        bins = packing.search_again(first, lengths, 2048, steps=steps)
        assert sorted(sum(bins, [])) == list(range(len(lengths)))
        assert max(sum(lengths[p] for p in b) for b in bins) <= 2048
        assert len(bins) <= len(packing.best_fit(sorted(lengths, reverse=True), 2048))
        if low > 1:
            assert len(bins) < len(first) and min(steps[k] for k in ("move", "one for one", "two for one")) > 0
    # Nothing fits the room of the first bin and no exchange of one for one adds to it; then the last one runs empty.
    steps = Counter()
    assert len(packing.local_search([[0, 1], [2, 3], [4]], [5, 3, 3, 3, 3], 10, steps)) == 2
    assert steps == {"two for one": 1, "move": 1}


def test_search_lists_all_pairs_of_a_bin():
    draw = random.Random(3)
    givers, held = packing._Givers(), []
    for position in range(400):
        if held and draw.random() < 0.4:
            length, rank = held.pop(draw.randrange(len(held)))
            givers.take(rank, length)
        else:
            length, rank = draw.randint(1, 30), draw.randint(0, 5)
            held.append((length, rank))
            givers.put(rank, length, position)
        singles = {length for length, _ in held}
        pairs = {a + b for i, (a, r) in enumerate(held) for b, q in held[i + 1 :] if r == q}
        assert singles == {n for n in range(61) if givers.singles.mask >> n & 1}
        assert pairs == {n for n in range(61) if givers.pairs.mask >> n & 1}


def test_search_packs_documents(docs):
    counted = Counter()
    lengths = [r.length for r in packing.token_pieces(docs, PATH, 2048, "doc_id", "text").orderBy("doc_id", "piece").collect()]
    bins = packing.search_again(packing.best_fit(lengths, 2048), lengths, 2048, steps=counted)
    assert len(bins) == math.ceil(sum(lengths) / 2048)
    assert sum(counted.values()) > 0 or len(packing.best_fit(lengths, 2048)) == len(bins)


def test_mixing(docs, rows, nothing):
    size = mixing.word_count(F.coalesce("text", F.lit("")))
    out = mixing.mix_sources(docs, size).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    total, names = sum(sizes.values()), sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, free = {}, float(total), set(names)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left, free = total - sum(3.0 * sizes[s] for s in names if s in target), free - over
    taken, largest = Counter(), Counter()
    for r in out:
        assert abs(r.target - target[r.row.source]) < 1e-6 and r.source_size == sizes[r.row.source] and 0 <= r.copies <= 3
        taken[r.row.source] += r.copies * r.size
        largest[r.row.source] = max(largest[r.row.source], r.size)
    assert all(abs(taken[s] - target[s]) <= 3 * largest[s] for s in names)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in out)
    assert mixing.mixed_documents(nothing).count() == 0


def test_ngram_join(docs, rows, nothing):
    documents, texts = ngram_join.similar_classes(docs)
    out = documents.join(texts, "node").collect()

    def grams(text):
        words = split(text)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, bodies = [grams(r[1]) for r in rows], [r[1] or "" for r in rows]
    linked = [
        {j for j in range(len(rows)) if j != i and (bodies[i] == bodies[j] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))}
        for i in range(len(rows))
    ]
    by_id = {rows[i][0]: len(linked[i]) for i in range(len(rows))}
    assert {r.doc_id: r.copies - 1 + r.linked for r in out} == by_id and len(out) == len(rows)
    classes = {r.doc_id: r.class_id for r in out}
    assert classes[8] == classes[7] == classes[6] == classes[None] == 6 and classes[4] == 3 and classes[2] == 2 and classes[1] == 0
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes.values()))
    assert ngram_join.one_per_class(nothing).count() == 0


def test_tiles_count_each_link_once(spark, monkeypatch):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(w if draw.random() > 0.004 else "new" for w in words) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "CHUNK_NODES", 7)
    documents, found = ngram_join.similar_classes(frame)
    got = {r.doc_id: r.copies - 1 + r.linked for r in documents.join(found, "node").collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(196)} for t in texts]
    assert got == {i: sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for i, a in enumerate(sets)}


def test_bands_reach_the_recall():
    bands, width = shingles.choose_bands(0.8, 0.999, 96)
    assert bands * width <= 96 and 1 - (1 - 0.8**width) ** bands >= 0.999


def test_bloom_scores(docs, rows, nothing):
    held = F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False))
    out = bloom_lm.bloom_scores(docs, held).collect()
    tokens = [split(r[1]) + [""] for r in rows]
    counts = Counter()
    for r, words in zip(rows, tokens):
        if r[0] is None or r[0] % 4 != 1:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (r[0], len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
        for r, w in zip(rows, tokens)
    )
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
    assert {r.train_tokens for r in out} == {n} and all(math.isfinite(r.score) and r.score <= 0 for r in out)
    assert bloom_lm.bloom_scores(nothing, held).count() == 0


def test_pairs_seen_once_are_evidence(spark):
    words = [f"w{i}" for i in range(40)]
    texts = {0: " ".join(words), 1: " ".join(words[5:15]), 2: " ".join(words[14:4:-1])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    score = {r.doc_id: r.score for r in bloom_lm.bloom_scores(frame, F.col("doc_id") > 0).collect()}
    assert score[1] > score[2] + 5


def exact_scores(rows, held):
    """The formula of the model on exact counts, put on its scale."""
    tokens = [split(r[1]) + [""] for r in rows]
    words, pairs = Counter(), Counter()
    for r, own in zip(rows, tokens):
        if not held(r):
            words.update(own)
            pairs.update(zip([""] + own[:-1], own))

    def level(n):
        return int(bloom_lm.levels_of(np.asarray([n]))[0]) if n else 0

    total = sum(words.values())
    unseen = min(0.5, (sum(n == 1 for n in words.values()) + 1) / (total + 1))
    spread = sum(bloom_lm.MIDDLE[level(n)] for n in words.values())
    for r, own in zip(rows, tokens):
        score = 0.0
        for h, w in zip([""] + own[:-1], own):
            p = (1 - unseen) * bloom_lm.MIDDLE[level(words[w])] / spread if words[w] else unseen
            a = bloom_lm.TRUST if words[h] else 0.0
            pair = min(1.0, bloom_lm.LEAST[level(pairs[h, w])] / max(1, words[h]))
            score += math.log10(a * pair + (1 - a) * p)
        yield r[0], len(own), score


def test_scores_equal_the_formula_on_exact_counts(docs, rows, monkeypatch):
    held = F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False))
    wanted = list(exact_scores(rows, lambda r: r[0] is not None and r[0] % 4 == 1))

    def gaps():
        found = [(r.doc_id, r.n_tokens, r.score) for r in bloom_lm.bloom_scores(docs, held).collect()]
        order = sorted(wanted, key=str)
        assert [x[:2] for x in sorted(found, key=str)] == [x[:2] for x in order]
        return [abs(a[2] - b[2]) / a[1] for a, b in zip(sorted(found, key=str), order)]

    found = gaps()  # a false hit moves the score of a short text
    assert sorted(found)[len(found) * 9 // 10] < 0.05 and sum(found) / len(found) < 0.05
    monkeypatch.setattr(bloom_lm, "BITS", 64)
    found = gaps()
    assert max(found) < 0.01 and sum(gap < 1e-9 for gap in found) > 0.9 * len(found)


def test_a_filter_that_stays_in_its_parts_scores_alike(docs, nothing, monkeypatch):
    held = F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False))

    def scores(most, **sizes):
        for name, value in {"MOST_BITS": most, **sizes}.items():
            monkeypatch.setattr(bloom_lm, name, value)
        out = bloom_lm.bloom_scores(docs, held)
        assert bloom_lm.bloom_scores(nothing, held).count() == 0
        return sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in out.collect())

    whole = scores(1 << 31, BITS=64)
    assert scores(0) == whole
    assert scores(1 << 31, PART_CHARS=500, BLOCK_BYTES=50, LOCAL_PAIRS=100, LOCAL_WORDS=5, WORD_SHARE=2) == whole
    assert scores(0, HEAD=3) == scores(1 << 31)


def test_filter_has_no_misses_and_few_false_hits():
    keys = shingles.mix(np.arange(20000, dtype=np.uint64))
    levels = np.random.default_rng(0).integers(1, 6, 20000)
    parts = bloom_lm.part_of(keys, 3)
    found = []
    for part in range(3):
        bits, size = bloom_lm.fill(keys[parts == part], levels[parts == part])
        found.append((part, bits.tobytes(), size))
    whole = bloom_lm.Filter(*bloom_lm.joined(4, [], 0))
    assert not whole.levels(keys).any()
    whole = bloom_lm.Filter(*bloom_lm.joined(3, found, sum(f[2] for f in found)))
    assert (whole.levels(keys) >= levels).all()
    others = shingles.mix(np.arange(50000, 70000, dtype=np.uint64))
    assert (whole.levels(others) > 0).mean() < 0.02


def test_packed_counts_come_back_summed():
    import pyarrow as pa

    draw = np.random.default_rng(3)
    keys = [np.unique(shingles.mix(draw.integers(0, 500, 300).astype(np.uint64))) for _ in range(4)]
    counts = [draw.integers(1, 1 << 40, len(k)) for k in keys]
    batches = [b for k, n in zip(keys, counts) for b in bloom_lm._pack(k, n, 5, 7)]
    table, wanted = pa.Table.from_batches(batches), Counter()
    for k, n in zip(keys, counts):
        wanted.update(dict(zip(k.tolist(), n.tolist())))
    found = {}
    for part in range(7, 12):
        own, n = bloom_lm._unpack(table.filter(pa.compute.equal(table["part"], part)))
        assert (bloom_lm.part_of(own, 5) == part - 7).all()
        found |= dict(zip(own.tolist(), n.tolist()))
    assert found == dict(wanted)


def test_long_texts_are_cut_between_words():
    import pyarrow as pa

    from gleanwork.llm import byte_words

    texts = ["aa bb  cc dd " * 9, "", "x" * 70, "short", " " * 40, "é ü " * 30 + "end"]
    found = [[] for _ in texts]
    for row, whole, data, offsets in byte_words.text_blocks(pa.array(texts), byte_words.NO_SPACE, 20):
        for i in range(len(offsets) - 1):
            found[row + i].append(bytes(data[offsets[i] : offsets[i + 1]]).decode())
    assert ["".join(x) for x in found] == texts
    assert [" ".join(x).split() for x in found] == [t.split() for t in texts]


def test_fingerprints(docs, rows, nothing):
    out = fingerprints.neighbour_fingerprints(docs).collect()
    assert len(out) == len(rows)
    marks = defaultdict(set)
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    by_id = {r[0]: r[1] or "" for r in rows}
    got = {r.doc_id: r for r in out}
    for r in out:
        marks[by_id[r.doc_id]].add(r.fingerprint)
        assert r.n_chars == len(by_id[r.doc_id])
    assert all(len(m) == 1 for m in marks.values())
    for i, r in enumerate(ordered):
        text, following = r[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        if r[0] != 6:
            assert got[r[0]].edited_sha256 == hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest()
    assert fingerprints.neighbour_fingerprints(nothing).count() == 0
    pairs = fingerprints.similar_pairs(docs.where("doc_id = 8"), docs.where("doc_id IS NOT NULL")).collect()
    assert {r.doc_id for r in pairs} == {6, 7}


def test_ranges_hand_over_their_first_document(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    texts = {i * 7 - 20: f"text number {i} " * (i + 1) for i in range(25)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.edited_sha256 for r in fingerprints.neighbour_fingerprints(frame).collect()}
    ids = sorted(texts, reverse=True)
    for i, number in enumerate(ids):
        text, following = texts[number], texts[ids[(i + 1) % len(ids)]]
        cut = len(text) // 3
        assert got[number] == hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest()


def test_similar_documents_equal_all_pairs(spark, docs, rows, nothing):
    draw = random.Random(12)
    base = [sentence(draw, draw.randint(3, 90)).split() for _ in range(20)]
    more = []
    for i in range(150):
        words = list(draw.choice(base))
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        more.append((100 + i, " ".join(words)))
    mixed = [(r[0], r[1]) for r in rows] + more
    frame = spark.createDataFrame(mixed, "doc_id long, text string").repartition(3)
    found = {r.id: r.similar_docs for r in fingerprints.similar_documents(frame, F.col("doc_id") % 3 == 0).collect()}
    hashes = shingles.word_hashes()
    sets = [set(shingles.shingles(t or "", hashes).tolist()) for _, t in mixed]
    wanted, links = Counter(), 0
    for i, (number, text) in enumerate(mixed):
        if number is not None and number % 3 == 0:
            alike = 0
            for j, (_, other) in enumerate(mixed):
                x, y = sets[i], sets[j]
                if i != j and ((text or "") == (other or "") or (x and y and len(x & y) >= 0.8 * len(x | y))):
                    alike += 1
            wanted[number] = max(wanted[number], alike)
            links += alike
    assert set(found) == set(wanted) and all(found[k] <= wanted[k] for k in found)
    assert sum(found.values()) >= 0.99 * sum(wanted.values()) > 50
    assert fingerprints.similar_documents(nothing, F.col("doc_id") % 3 == 0).count() == 0


def test_fingerprints_of_other_ids(spark, monkeypatch):
    """Text ids, null ids and ids of many rows are dealt over ranges as well; likenesses are true ones."""
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 5)
    draw = random.Random(8)
    rows = [(f"k{i:03d}", sentence(draw, draw.randint(0, 60))) for i in range(60)]
    rows += [(None, sentence(draw, 30)) for _ in range(25)] + [("k007", sentence(draw, 20)) for _ in range(25)]
    frame = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    got = fingerprints.neighbour_fingerprints(frame).collect()
    hashes = frame.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    given = sorted((r for r in hashes if r.doc_id is not None), key=lambda r: r.h)
    ordered = sorted(given, key=lambda r: r.doc_id, reverse=True) + sorted((r for r in hashes if r.doc_id is None), key=lambda r: r.h)
    assert len(got) == len(rows)
    found = {(r.doc_id, r.fingerprint, r.edited_sha256): r for r in got}
    functions, words = shingles.permutations(fingerprints.HASHES), shingles.word_hashes()

    def jaccard(a, b):
        x, y = (set(shingles.shingles(t, words, lead=True).tolist()) for t in (a, b))
        return len(x & y) / len(x | y) if x | y else 1.0

    gaps = []
    for i, r in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)].text
        cut = len(r.text) // 3
        edited = r.text[: len(r.text) - cut] + following[:cut]
        mark = fingerprints.to_text(fingerprints.signature(r.text, words, functions))
        row = found[r.doc_id, mark, hashlib.sha256(edited.encode()).hexdigest()]
        gaps += [abs(row.near_edited - jaccard(r.text, edited)), abs(row.near_next - jaccard(r.text, following))]
    assert max(gaps) < 0.25 and sum(gaps) / len(gaps) < 0.04


def test_grammar_tapes():
    symbols, grammar = toxicity.Symbols({"idiot": 5.0, "idioti*": 4.0, "idio*": 9.0}), toxicity.Grammar()

    def tapes(text):
        return [t for _, _, t in toxicity.matched_clauses(text, symbols, grammar)]

    assert tapes("Nothing here. An idiot!") == [[5.0, 0.0, 0.0]]
    assert tapes("you are an idiot, idiotic") == [[13.5, 0.0, 0.0]]
    assert tapes("he is not an idiot") == [[0.0, 7.5, 0.0]]
    assert tapes("Ann said idiot; fine") == [[0.0, 0.0, 5.0]]
    assert tapes("I will hurt you.") == [[9.0, 0.0, 0.0]]
    assert tapes("hurt. you") == [] and tapes("") == [] and tapes("idioms") == []
    assert tapes("I will not hurt you.") == [[0.0, 9.0, 0.0]] and tapes("Ann said I will hurt you") == [[0.0, 0.0, 9.0]]
    assert tapes("hurt a b you") == [[9.0, 0.0, 0.0]] and tapes("hurt a b c you") == []
    text = "clean line\nan idiot. more"
    ((begin, end, _),) = toxicity.matched_clauses(text, symbols, grammar)
    assert text[begin:end] == "an idiot."


def test_learned_scores_follow_the_clause(spark):
    """With the model that the labels teach: a negated or reported sentence scores below its affirmed one."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.train_toxicity(docs, labels.where(crc_mod("doc_id", 3) != 1).select("doc_id", "toxic"))

    def scores(*texts):
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.id: r.score for r in toxicity.score_toxicity(frame, model).collect()}
        return [found[i] for i in range(len(texts))]

    for affirmed in ("you are a {}.", "he is {}", "that {} again!"):
        for insult in ("idiot", "moron", "loser", "pathetic", "worthless"):
            plain = affirmed.format(insult)
            whole, negated, reported = scores(plain, plain.replace(insult, "not " + insult), "they said " + plain)
            assert negated < reported < whole and negated < 0.5 and whole >= toxicity.CUT
    harm, no_harm, process, paths, calm = scores(
        "i will kill you.", "i will not kill you.", "we kill the process and send it to you.", "not worth it, the paths are long",
        "the losers of the game wrote a clause",
    )
    assert harm >= toxicity.CUT > 0.5 > max(no_harm, process, paths, calm)
    held = toxicity.score_toxicity(docs.where(crc_mod("doc_id", 3) == 1), model)
    told = held.join(labels.withColumnRenamed("doc_id", "id"), "id").groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") >= toxicity.CUT).alias("said")
    )
    said = {r.toxic: (r.said, r.n) for r in told.collect()}
    assert said[1][0] >= 125 and said[0][0] <= 2


def test_slopes_are_never_negative():
    x = np.asarray([0.0, 0, 0, 2, 3])
    assert toxicity.fit_logistic(x, np.asarray([1.0, 1, 1, 0, 0]))[0] == 0.0
    slope, constant = toxicity.fit_logistic(x, np.asarray([0.0, 0, 0, 1, 1]))
    assert slope > 0 > constant
    assert toxicity.fit_logistic(x, np.zeros(5)) == toxicity.fit_logistic(x[:0], x[:0])[:1] + (math.log(0.5 / 5.5),)


def test_toxicity_odd_tables(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == len(rows)
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert toxicity.drop_toxic(nothing, labels).count() == 0


@pytest.mark.parametrize("name,label", [("op2_toxicity_grammar", "toxic"), ("op8_quality_mil", "quality")])
def test_held_out_accuracy(spark, name, label):
    from gleanwork.llm.book import BOOK

    folder = "/root/testdata/sf0.01"
    scored = BOOK[name][0](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    right = scored.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right > 0.9


def test_attention_gradient():
    draw = np.random.default_rng(1)
    x, starts, y = draw.normal(size=(9, quality.WIDTH)), np.array([0, 2, 5]), np.array([1.0, 0.0, 1.0])
    m = quality.start_weights()

    def loss(w):
        p, _ = quality.forward(w, x, starts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slope = quality.gradient(m, x, starts, y, decay=0.0)
    for k in m:
        at = tuple(0 for _ in m[k].shape)
        up, down = {**m, k: m[k].copy()}, {**m, k: m[k].copy()}
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - slope[k][at]) < 1e-6


def test_quality_odd_tables(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    out = quality.score_quality(docs, quality.train_quality(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    model = quality.train_quality(nothing, labels.limit(0))
    assert quality.score_quality(nothing, model).count() == 0


def page(body, n=0):
    return (
        f"<html><head><title>T{n}</title></head><body><nav><ul><li><a href='/'>Home {n}</a><li>About</ul></nav>"
        f"<div class='cookie notice'>We use cookies</div>{body}<footer>&copy; me</footer></body></html>"
    )


def test_pages(spark):
    article = "<article><h1>A&amp;B</h1><p>First <b>bold</b>\n line<br>next<p>Second<aside>no</aside><form>no</form><p>Third<div id='comments'><p>no</div></article>"
    plain = [page(f"<div class=box><p>Text {i} of the page<p>More {i}</div><p>Same on all", i) for i in range(4)]
    rows = [(1, "http://a.com/1", page(article)), (2, "http://a.com/2", page("<article><p>Only</p></article>")), (3, None, None)]
    rows += [(4, "x", ""), (5, "http://A.com/3", "<p>no <<< tags > here"), (5, "http://A.com/3", "<p>no <<< tags > here")]
    rows += [(10 + i, "http://b.com/", p) for i, p in enumerate(plain)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in page_text.page_texts(frame).collect()}
    assert got[1] == "A&B\nFirst bold line next\nSecond\nThird"
    assert got[2] == "Only" and got[3] == "" and got[4] == ""
    assert [got[10 + i] for i in range(4)] == [f"Text {i} of the page\nMore {i}" for i in range(4)]
    assert page_text.page_texts(frame).count() == len(rows)
    assert page_text.page_texts(frame.limit(0)).count() == 0


def test_wrappers_align():
    one = page_text.page_stream("<div><p>Same</p><p>a</p></div>")
    two = page_text.page_stream("<div><h2>x</h2><p>Same</p></div>")
    merged = page_text.align(one, two)
    assert any(item[0] == "?" for item in merged)
    assert page_text.align(merged, one) == page_text.align(merged, two) == merged
    stream = page_text.page_stream("".join(f"<h{i % 6 + 1}>x</h{i % 6 + 1}><p>{i}" for i in range(900)))
    assert page_text.align(page_text.align(stream, one), stream) == page_text.align(stream, one)
    for hostile in ("<div>" * 3000, "<p '" * 3000, "<!--" * 3000, "<li>x" * 3000, "<a \">" * 3001):
        page_text.main_text(hostile, set())
        page_text.page_stream(hostile)


def texts_of(spark, *pages, url="http://a.com/"):
    rows = [(i, url, p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in page_text.page_texts(frame).orderBy("page_id").collect()]


def test_pages_with_nested_and_mixed_elements(spark):
    nested = "<body><div><div><p>In two</p></div></div>{}</body>"
    assert texts_of(spark, nested.format("")) == ["In two"]
    assert texts_of(spark, nested.format("<article><p>After</p></article>")) == ["After"]
    lists = "<body><ul><li><ul><li>Inner</li></ul></li></ul><p>Below</p></body>"
    assert texts_of(spark, lists) == ["Inner\nBelow"]
    assert texts_of(spark, "<ul><li><ul><li>a<li>b<li>c</ul><li>d<li>e</ul>") == ["a\nb\nc\nd\ne"]
    kinds = [("h2", "ul"), ("h3", "ol"), ("h2", "ol")]
    mixed = [f"<body><{h}>T{i}</{h}><{u}><li>L{i}</{u}><p>P{i}</body>" for i, (h, u) in enumerate(kinds)]
    assert texts_of(spark, *mixed) == [f"T{i}\nL{i}\nP{i}" for i in range(3)]
    apart = ["<body><div><p>x</div><article><p>One</article></body>", "<body><div><p>y</div><div><p>Two</div><article><p>2</article></body>"]
    assert texts_of(spark, *apart) == ["One", "2"]


def test_each_page_is_judged_by_itself(spark):
    box = [f"<body><div><p>Box {i}</div><section><p>Always</section></body>" for i in range(3)]
    pages = ["<body><article><p>Art</article></body>", *box]
    assert texts_of(spark, *pages, url=None) == ["Art", "Box 0", "Box 1", "Box 2"]
    assert texts_of(spark, "<article><p>Only</p></article>", "<p>no <<< tags > here", url="http://A.com/3")[1] == "no <<< tags > here"
    once = [f"<body><p>Text {i}</p>{'<blockquote>Said once</blockquote>' if i == 1 else ''}</body>" for i in range(4)]
    assert texts_of(spark, *once) == ["Text 0", "Text 1\nSaid once", "Text 2", "Text 3"]
    assert texts_of(spark, *["<body><p>Same page</body>"] * 4) == ["Same page"] * 4


def test_names_of_states_are_no_noise(spark):
    pages = [
        "<body class='post-template has-sidebar'><p>a<div class=sidebar>no</div></body>",
        "<html class='no-cookie'><body><p>b</body></html>",
        "<body><div class='content with-comments'><p>c</div></body>",
        "<body><article class='post ad-free'><p>d</article></body>",
        "<body><div class='banner'><article><p>e<div class='share-box'>no</div></article></div></body>",
        "<body><form id=page><main>f</main></form></body>",
        "<body><p>g<ol class=comments><li><article class='comment-body'>no</article></ol></body>",
        "<body><div class='promo'><div class='post'>h</div></div></body>",
        "<body><div class='site-footer'>no</div><nav><article>no</article></nav><p>i</body>",
    ]
    alone = [(i, f"http://{i}.com/", p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(alone, "page_id long, url string, html string")
    assert [r.text for r in page_text.page_texts(frame).orderBy("page_id").collect()] == list("abcdefghi")


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder).checkpoint()
        if name != "best-fit packing":
            assert out.columns == columns
            assert out.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0 or name.startswith("mixing")
            docs = out
    assert out.where("piece = 0").count() == docs.count()
