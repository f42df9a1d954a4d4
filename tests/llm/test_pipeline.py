"""Every stage of the pipeline against plain Python, each on what the stage before it kept."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gleanwork.llm import toxicity
from gleanwork.llm.common import crc_mod

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows before the first stage and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).checkpoint()
        out.append(docs.collect())
    return out


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ids(rows):
    return Counter(r.doc_id for r in rows)


def toxic_score(text, insults, weights):
    """Reads each clause by looking back from every token instead of running machines."""
    sums = [0.0, 0.0, 0.0]
    for line in text.split("\n"):
        tokens = line.split()
        ends = [i + 1 for i, token in enumerate(tokens) if token[-1] in ".!?;:" or i == len(tokens) - 1]
        for start, end in zip([0, *ends], ends):
            kinds, weight = [], []
            for token in tokens[start:end]:
                kind, best = toxicity.OTHER, 0.0
                for word in toxicity.LETTERS.findall(token.lower()):
                    kind = toxicity.CLASSES.get(word, kind)
                    names = [word] + [word[:n] + "*" for n in range(6, 9) if len(word) > n]
                    best = max([best] + [insults.get(name, 0.0) for name in names])
                kinds.append(toxicity.INSULT if best else kind)
                weight.append(best)
            tapes = [0.0, 0.0, 0.0]
            for i, kind in enumerate(kinds):
                before = kinds[:i]
                tape = 1 if toxicity.NEGATION in before[-3:] else 2 if toxicity.REPORT in before else 0
                steps = [k for k in before[-3:] if k in (toxicity.THREAT, toxicity.TARGET)]
                if kind == toxicity.INSULT:
                    tapes[tape] += weight[i]
                elif kind == toxicity.TARGET and steps[-1:] == [toxicity.THREAT]:
                    tapes[tape] += toxicity.THREAT_WEIGHT
            if any(tapes):
                factor = 1.5 if toxicity.TARGET in kinds else 1.0
                sums = [s + factor * t for s, t in zip(sums, tapes)]
    evidence = math.log1p(sums[0] + 0.1 * sums[1] + 0.4 * sums[2])
    return 1 / (1 + math.exp(-(weights[0] * evidence + weights[1])))


def test_toxicity(spark, kept):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    insults, weights = toxicity.train_toxicity(docs, labels.where(crc_mod("doc_id", 3) != 1))
    want = Counter(r.doc_id for r in kept[0] if toxic_score(r.text or "", insults, weights) < 0.7)
    assert ids(kept[1]) == want and len(kept[1]) < len(kept[0])


def test_exact_duplicates(kept):
    last = {}
    for r in kept[1]:
        last[r.text or ""] = max(r.doc_id, last.get(r.text or "", r.doc_id))
    assert ids(kept[2]) == Counter(last.values())


def test_near_duplicates(kept):
    rows = sorted(kept[2], key=lambda r: r.doc_id)
    sets = []
    for r in rows:
        words = words_of(r.text)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            if a and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    assert ids(kept[3]) == Counter(r.doc_id for i, r in enumerate(rows) if find(i) == i)


def test_mixing(kept):
    sizes = {r.doc_id: len(words_of(r.text)) for r in kept[3]}
    total = Counter()
    for r in kept[3]:
        total[r.source] += sizes[r.doc_id]
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target = {}
    while len(target) < len(names):
        rest = [s for s in names if s not in target]
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * level > 3 * total[s]]
        target |= {s: 3.0 * total[s] for s in over} if over else {s: weight[s] * level for s in rest}

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:4], 16)

    by_source = defaultdict(list)
    for r in kept[3]:
        size = sizes[r.doc_id]
        step = math.floor(8 * math.log2(size + 1) + 1e-9)
        by_source[r.source].append((step, number(str(r.doc_id)) % 64, size, r.doc_id))
    want = Counter()
    for source, places in by_source.items():
        offset = (number("mix" + ("" if source is None else "=" + source)) + 0.5) / 65536
        rate = target[source] / total[source] if total[source] else 0.0
        for place, (*_, doc_id) in enumerate(sorted(places), 1):
            want[doc_id] += min(3, math.floor(rate * place + offset) - math.floor(rate * (place - 1) + offset))
    assert ids(kept[4]) == +want


def test_packing(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in kept[4]:
        tokens = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(tokens), 2048)):
            part = np.asarray(tokens[at : at + 2048], "<u4").tobytes()
            want[(r.doc_id, piece, at, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in kept[5]) == want
    sequences = defaultdict(list)
    for r in kept[5]:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(r.length for r in kept[5]) / 2048) + 1
