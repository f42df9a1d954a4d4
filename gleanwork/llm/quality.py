"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded by the shares of kinds of
characters, the share of distinct four-byte runs and its length; a layer maps it to a representation. A gated
attention weighs the passages of a bag against each other, and the weighted representation is scored. All
weights are learned from document labels, on at most about ``MOST_LABELLED`` labelled rows chosen by a hash
of the id; each passage of their texts takes part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.common import crc_mod, full_text, table
from gleanwork.llm.toxicity import labelled_sample

MOST_LABELLED = 6000
PASSAGE = 512
HIDDEN = 16
GATE = 8
STEPS = 400
CUT = 0.3

# The kinds of bytes.
KINDS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t", b".", b",", b"!?",
    b"%$#&*@", b"|/\\<>{}[]=+_~^", b"'\"()-:;`",
)
WIDTH = len(KINDS) + 1 + 5


def _kind_table() -> np.ndarray:
    kinds = np.full(256, len(KINDS), np.int64)
    for number, members in enumerate(KINDS):
        kinds[list(members)] = number
    return kinds


KIND = _kind_table()


def encode(text: str) -> np.ndarray:
    """A row per passage. An empty text is one passage of nothing."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return np.zeros((1, WIDTH), np.float32)
    n = -(-len(data) // PASSAGE)
    passage = np.arange(len(data)) // PASSAGE
    columns = len(KINDS) + 1
    shares = np.bincount(passage * columns + KIND[data], minlength=n * columns).reshape(n, columns).astype(np.float32)
    sizes = np.minimum(PASSAGE, len(data) - PASSAGE * np.arange(n)).astype(np.float32)[:, None]
    shares /= sizes
    padded = np.zeros(n * PASSAGE + 3, np.uint32)
    padded[: len(data)] = data
    runs = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24
    runs = np.sort(runs.reshape(n, PASSAGE), axis=1)
    distinct = 1 + (runs[:, 1:] != runs[:, :-1]).sum(axis=1, keepdims=True)
    distinct = distinct / sizes
    blanks = shares[:, 3:4]
    word = np.minimum((1 - blanks) / np.maximum(blanks, 0.01), 40) / 10
    letters = shares[:, :2].sum(axis=1, keepdims=True) + shares[:, -1:]
    capital = shares[:, 1:2] / np.maximum(letters, 0.01)
    x = np.column_stack([np.sqrt(shares), distinct, word, capital, np.log1p(sizes) / 6, np.minimum(sizes / PASSAGE, 1)])
    return x.astype(np.float32)


def start_weights(seed: int = 3) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    shapes = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": (1,)}
    return {k: draw.normal(0, 0.5 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s) for k, s in shapes.items()}


def forward(m: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    """Scores of the bags (rows of ``x`` from one start to the next), and what the backward pass needs."""
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    e = (t * g) @ m["w"]
    sizes = np.diff([*starts, len(x)])
    a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a /= np.repeat(np.add.reduceat(a, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ m["c"] + m["d"][0], -30, 30)))
    return p, (h, t, g, a, z, sizes)


def gradient(m, x, starts, y, decay: float = 1e-4):
    p, (h, t, g, a, z, sizes) = forward(m, x, starts)
    up = (p - y) / len(y)
    dz = np.repeat(up, sizes)[:, None] * m["c"]
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
    dt, dg = de[:, None] * m["w"] * g * (1 - t * t), de[:, None] * m["w"] * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ m["V"].T + dg @ m["U"].T) * (1 - h * h)
    out = {
        "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
        "c": z.T @ up, "d": np.asarray([up.sum()]),
    }
    return {k: v + decay * m[k] for k, v in out.items()}


def fit(x: np.ndarray, starts: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.03):
    """Adam on all bags; without both labels only the constant is set."""
    m = start_weights()
    share = (y.sum() + 0.5) / (len(y) + 1)
    m["d"] = np.asarray([np.log(share / (1 - share))])
    if len(y) == 0 or y.min() == y.max():
        m["c"] = np.zeros(HIDDEN)
        return m
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    for step in range(1, steps + 1):
        slope = gradient(m, x, starts, y)
        for k in m:
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.99 * second[k] + 0.01 * slope[k] ** 2
            m[k] = m[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return m


def _encode_rows(batches):
    schema = pa.schema([("label", pa.int32()), ("passages", pa.binary())])
    for batch in batches:
        coded = [encode(text).tobytes() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(coded, pa.binary())], schema=schema)


def train_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST_LABELLED):
    """The weights, from the rows of ``labels`` (``doc_id, quality``)."""
    sample = labelled_sample(labels, "quality", doc_id, most)
    rows = docs.select(F.col(doc_id).alias("id"), full_text(text).alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id")
    )
    coded = rows.select("label", "text").mapInArrow(_encode_rows, "label int, passages binary").collect()
    coded.sort(key=lambda row: (row["label"], bytes(row["passages"])))
    bags = [np.frombuffer(row["passages"], np.float32).reshape(-1, WIDTH) for row in coded]
    y = np.asarray([row["label"] for row in coded], float)
    x = np.concatenate(bags) if bags else np.zeros((0, WIDTH))
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    return fit(x.astype(float), starts, y)


def _score_rows(model, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            scores, attended = [], []
            for text in batch.column(1).to_pylist():
                x = encode(text)
                p, (_, _, _, a, _, _) = forward(model, x.astype(float), np.zeros(1, np.int64))
                scores.append(float(p[0]))
                attended.append(int(a.argmax()))
            arrays = [batch.column(0), pa.array(scores), pa.array(attended, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(arrays, schema)], schema=schema)

    return run


def score_quality(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score, passage`` (number of the passage that weighs most) per row; null texts are empty.

    Rows are scored one by one, whatever their id is; equal texts get equal scores, long ones are read
    whole. An empty table gives no rows; without labels all texts get the same score.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[doc_id].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("score", pa.float64()), ("passage", pa.int32())])
    rows = docs.select(F.col(doc_id).alias("id"), full_text(text).alias("text"))
    return rows.mapInArrow(_score_rows(model, schema), f"id {kind.simpleString()}, score double, passage int")


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_quality(docs, labels.where(crc_mod("doc_id", 5) != 0).select("doc_id", "quality"))
    return score_quality(docs, model).select(
        F.col("id").alias("doc_id"),
        (crc_mod("id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        "passage",
    )


BOOK = {"op8_quality_mil": (op8_quality_mil, None)}
