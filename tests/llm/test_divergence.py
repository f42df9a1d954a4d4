"""The audit of sources against brute force, on odd rows and small parts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gleanwork.llm import divergence

COLUMNS = "doc_id long, text string, lang string, source string, term string, n int, p string"


def brute_force(rows, least, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [
            re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        ]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        here = sorted(s for l, s in groups if l == lang)
        whole = Counter()
        for s in here:
            whole.update(counts[lang, s])

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, ps = shares(whole), {s: shares(counts[lang, s]) for s in here}
        for s in here:
            pairs = [(sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in here if o != s]
            terms = [(ps[s][t] - q[t], t) for t in kept if counts[lang, s][t] > 0 and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    words = ["a", "Be", "the", "été", "ÉTÉ", "eightlet", "ninelette", "sixteen" + "x" * 9, "y" * 17, "y" * 18, "Z" * 33, "日本語"]
    words += ["w" * 40, "w" * 41, "ab1cd", "don't", "x y", "x_y", "ÿ", "z\x00q"]
    out = [(1, None, "en", "s0"), (2, "", "en", "empty"), (3, "1 2 3", None, None), (4, "lone", "fr", "s1"), (5, None, "xx", "t")]
    for i in range(120):
        text = " ".join(draw.choice(words[i % 3 :]) for _ in range(draw.randint(0, 30)))
        out.append((i, text, draw.choice(["en", "en", None]), draw.choice(["s0", "s1", "s2", None, "S3"])))
    return out + [out[20]] * 5 + [(None, "the " * 3000, "en", "s2")]


def audit(spark, rows, **kw):
    frame = spark.createDataFrame([(*row, "t", 1, "p") for row in rows], COLUMNS).repartition(3)
    return sorted(tuple(r) for r in divergence.source_divergence(frame, **kw).collect())


def test_divergence(spark, rows):
    assert audit(spark, rows, least=20, top=4) == brute_force(rows, 20, 4)
    assert audit(spark, rows, least=10**6) == brute_force(rows, 10**6, 50)


def test_small_parts_and_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "PART_TERMS", 3)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 50)
    assert audit(spark, rows, least=5, top=50) == brute_force(rows, 5, 50)


def test_empty_table(spark):
    assert audit(spark, []) == []


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 4 * 10**15
    got = spark.range(1).select(divergence._share(F.lit(big), F.lit(big + 12345), F.lit(777))).first()[0]
    assert got == 1 + 10**9 * (big + 5) // (big + 12345 + 5 * 777)


def test_radix_order():
    draw = np.random.default_rng(2)
    a, b = draw.integers(0, 3, 1000).astype(np.uint64) << np.uint64(40), draw.integers(0, 2**63, 1000).astype(np.uint64) % 50
    assert (divergence.radix_order([a, b]) == np.lexsort((a, b))).all()
