from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.llm import bloom_lm
from gleanwork.workspace import shared_dir


def texts(count: int, most: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(3000)]
    weights = [1 / (i + 3) for i in range(len(words))]
    return [" ".join(draw.choices(words, weights, k=draw.randint(0, most))) for _ in range(count)]


def size_of(path: Path) -> int:
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_a_filter_in_its_parts_stages_less_than_the_texts(spark, tmp_path, monkeypatch):
    rows = list(enumerate(texts(2000, 300, 1)))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 0)
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = size_of(shared)
    assert len(bloom_lm.bloom_scores(docs, F.col("doc_id") % 7 == 2).collect()) == len(rows)
    assert size_of(shared) - before < 1.5 * size_of(tmp_path)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_chunks_get_the_scores_of_whole_texts(spark, monkeypatch, kind):
    own = texts(120, 60, 2) + [" ".join(texts(30, 60, 3)), None, "", "  A a\tB b ", "A a B b"]
    rows = [(None if i % 11 == 0 else i // 2, text, [True, False, None, False][i % 4]) for i, text in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    docs = docs.select(F.col("doc_id").cast(kind), "text", "held").localCheckpoint()
    monkeypatch.setattr(bloom_lm, "BITS", 64)

    def scores(**sizes):
        for name, value in sizes.items():
            monkeypatch.setattr(bloom_lm, name, value)
        out = bloom_lm.bloom_scores(docs, F.col("held"))
        assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        return sorted(
            (
                str(r.doc_id), str(r.held_out), r.n_tokens, r.n_known, r.train_tokens,
                round(r.base_score, 6), round(r.score, 6),
            )
            for r in out.collect()
        )

    whole = scores(MOST_BITS=1 << 31)
    assert len(whole) == len(rows) and {x[1] for x in whole} == {"True", "False", "None"}
    assert scores(MOST_BITS=0) == whole
    assert scores(PART_CHARS=900, WORD_SHARE=2, BLOCK_BYTES=80, LOCAL_PAIRS=150, SENT_BYTES=200, STEP=40) == whole
    assert scores(HEAD=5) == scores(MOST_BITS=1 << 31)


@pytest.mark.parametrize("held", [True, None])
def test_chunks_without_training_texts(spark, monkeypatch, held):
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 0)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = bloom_lm.bloom_scores(docs, F.lit(held).cast("boolean")).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]


@pytest.mark.parametrize("kind", [np.uint8, np.uint32, np.uint64])
def test_squeezed_numbers_come_back(kind):
    draw = np.random.default_rng(0)
    for n in (0, 1, 1000):
        values = draw.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True)
        found = bloom_lm._stretch(bloom_lm._squeeze(values), kind)
        assert found.dtype == kind and (found == values).all()
