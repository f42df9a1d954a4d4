"""Toxicity by a weighted finite-state pattern grammar.

Small transducers each read the symbols of a clause (insult, threat, target, negation, reported speech,
other words): the negation machine remembers a negation for three words, the reporting machine remains in
reported speech to the end of the clause, the target machine remembers that somebody was addressed, the
threat machine waits three words for a target. Their composition reads a clause once and writes each match on one
of three tapes: affirmed, negated or reported. A document's evidence is what its matched clauses affirm, and a share of
what they report (``REPORTED_SHARE``) or negate (``NEGATED_SHARE``); its score grows with the evidence.

The insults are learned: words and long word beginnings that labelled toxic texts have far more often than
others, weighted by the log odds. The list is learned on two thirds of the labelled training texts, and
what the evidence counts for on the last third, so chance finds don't pass for evidence. Both use at most about
``MOST_LABELLED`` rows, chosen by a hash of the id.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.common import crc_mod, full_text, table
from gleanwork.workspace import materialise

MOST_LABELLED = 20_000
LEAST_ODDS = 3.5
LEAST_TEXTS = 4
LEAST_SHARE = 0.01
#: Shorter beginnings are beginnings of common words as well.
BEGINNINGS = range(6, 9)
THREAT_WEIGHT = 6.0
REPORTED_SHARE, NEGATED_SHARE = 0.4, 0.1
CUT = 0.7
CACHE = 400_000

# The words of the closed classes, in four languages.
TARGETS = "you your you're u he she they them him her this that du dich dir ihr euch er sie tu toi vous il elle ils tú usted ustedes él ella ellos"
NEGATIONS = "not no never isn't aren't don't without nicht kein keine nie ne pas jamais sans nunca jamás sin"
REPORTS = "said says say called wrote claimed quoted reported sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó"
THREATS = "kill hurt destroy murder shoot stab töten umbringen schlagen tuer frapper matar golpear"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLASSES = {
    word: symbol
    for symbol, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS))
    for word in words.split()
}
AFFIRMED, NEGATED, REPORTED = range(3)
MET = 4

TOKEN = re.compile(r"\S+")
LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
CLAUSE_ENDS = tuple(".!?;:")


def negation(state: int, symbol: int) -> int:
    return 3 if symbol == NEGATION else max(0, state - 1)


def reporting(state: int, symbol: int) -> int:
    return 1 if symbol == REPORT else state


def target(state: int, symbol: int) -> int:
    return 1 if symbol == TARGET else state


def threat(state: int, symbol: int) -> int:
    """0: nothing, 1 to 3: a threat waits for its target that many words, MET: it has met its target."""
    if symbol == THREAT:
        return 3
    if state != MET and state > 0:
        return MET if symbol == TARGET else state - 1
    return 0


MACHINES = (negation, reporting, target, threat)


class Grammar:
    """The composition of the machines; the arcs of the product are made when first used."""

    def __init__(self):
        self.arcs: dict[tuple, tuple] = {}

    def step(self, state: tuple, symbol: int) -> tuple:
        arc = self.arcs.get((state, symbol))
        if arc is None:
            following = tuple(machine(s, symbol) for machine, s in zip(MACHINES, state))
            tape = NEGATED if state[0] else REPORTED if state[1] else AFFIRMED
            arc = self.arcs[(state, symbol)] = (following, tape)
        return arc

    def clause(self, symbols: list[tuple[int, float]]) -> list[float]:
        """What the clause writes on the three tapes; a match counts half more if somebody is addressed."""
        state, tapes = (0, 0, 0, 0), [0.0, 0.0, 0.0]
        for symbol, weight in symbols:
            following, tape = self.step(state, symbol)
            if symbol == INSULT:
                tapes[tape] += weight
            elif following[3] == MET:
                tapes[tape] += THREAT_WEIGHT
            state = following
        return [tape * 1.5 for tape in tapes] if state[2] else tapes


def word_features(word: str):
    yield word
    for size in BEGINNINGS:
        if len(word) > size:
            yield word[:size] + "*"


class Symbols(dict):
    """Symbol and weight of a token, found once per task."""

    def __init__(self, insults: dict[str, float]):
        super().__init__()
        self.insults = insults

    def __missing__(self, token: str) -> tuple[int, float]:
        if len(self) >= CACHE:
            self.clear()
        best, symbol = 0.0, OTHER
        for word in LETTERS.findall(token.lower()):
            symbol = CLASSES.get(word, symbol)
            best = max(best, max((self.insults.get(f, 0.0) for f in word_features(word)), default=0.0))
        value = self[token] = (INSULT, best) if best > 0 else (symbol, 0.0)
        return value


def matched_clauses(text: str, symbols: Symbols, grammar: Grammar):
    """``(begin, end, [affirmed, negated, reported])`` of each clause that matches."""
    line_start = 0
    for line in text.split("\n"):
        clause, begin = [], None
        tokens = list(TOKEN.finditer(line))
        for i, token in enumerate(tokens):
            begin = token.start() if begin is None else begin
            clause.append(symbols[token[0]])
            if token[0].endswith(CLAUSE_ENDS) or i == len(tokens) - 1:
                tapes = grammar.clause(clause)
                if any(tapes):
                    yield line_start + begin, line_start + token.end(), tapes
                clause, begin = [], None
        line_start += len(line) + 1


def evidence(matches) -> float:
    """What the matched clauses say of the document, on a logarithmic scale."""
    shares = {AFFIRMED: 1.0, NEGATED: NEGATED_SHARE, REPORTED: REPORTED_SHARE}
    return math.log1p(sum(share * tapes[tape] for _, _, tapes in matches for tape, share in shares.items()))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> tuple[float, float]:
    """Slope and constant, by Newton's steps; the slope is never negative. Without both labels the constant alone."""
    design = np.column_stack([x, np.ones(len(x))])
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = math.log(share / (1 - share))
    weights = np.asarray([0.0, prior])
    if len(y) == 0 or y.min() == y.max():
        return 0.0, prior
    penalty = np.asarray([ridge, 1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (p - y) + penalty * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        weights -= move * min(1.0, 4.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return (float(weights[0]), float(weights[1])) if weights[0] > 0 else (0.0, prior)


def _count_features(batches):
    counts: Counter = Counter()
    schema = pa.schema([("feature", pa.string()), ("label", pa.int32()), ("n", pa.int64())])

    def rows():
        features = [f for f, _ in counts]
        labels = pa.array([label for _, label in counts], pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(features), labels, pa.array(list(counts.values()), pa.int64())], schema=schema)

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(LETTERS.findall(text.lower()))
            counts.update({(f, label) for word in words for f in word_features(word)})
            if len(counts) > 1_000_000:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def _score_rows(insults: dict[str, float], weights: tuple[float, float] | None, schema: pa.Schema):
    def run(batches):
        symbols, grammar = Symbols(insults), Grammar()
        for batch in batches:
            found, scores, spans = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                some = any(s[0] in (INSULT, THREAT) for s in map(symbols.__getitem__, text.split()))
                matches = list(matched_clauses(text, symbols, grammar)) if some else []
                found.append(evidence(matches))
                if weights is not None:
                    logit = weights[0] * found[-1] + weights[1]
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))))
                spans.append([{"begin": b, "end": e, "weight": sum(t)} for b, e, t in matches])
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(found, pa.float64()), pa.array(scores if weights is not None else [None] * len(found), pa.float64())]
            arrays.append(pa.array(spans, schema.field("clauses").type))
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return run


def _schema(frame: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_schema

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    ddl = f"{names}, evidence double, score double, clauses array<struct<begin:int,end:int,weight:double>>"
    from pyspark.sql.types import StructType

    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def apply_grammar(rows: DataFrame, insults: dict[str, float], weights: tuple[float, float] | None) -> DataFrame:
    """``rows`` has the text as its last column; it gives way to ``evidence, score, clauses``."""
    ddl, schema = _schema(rows)
    return rows.mapInArrow(_score_rows(insults, weights, schema), ddl)


def labelled_sample(labels: DataFrame, label: str, doc_id: str, most: int) -> DataFrame:
    """``label_id, label`` of about ``most`` rows at most, by a hash of the id; an id counts once."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("label_id")).agg(F.max(label).cast("int").alias("label"))
    share = most / max(1, known.count())
    if share >= 1:
        return known
    return known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def train_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST_LABELLED):
    """The insults with their weights, and what the evidence counts for, from the rows of ``labels`` (``doc_id, toxic``)."""
    sample = labelled_sample(labels, "toxic", doc_id, most)
    rows = docs.select(F.col(doc_id).alias("id"), full_text(text).alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id")
    )
    rows = materialise(
        rows.select("text", "label", F.xxhash64("text").alias("mark"), (F.pmod(F.xxhash64("text"), F.lit(3)) == 0).alias("last")),
        "toxic-sample",
    )
    learn = rows.where("NOT last")
    toxic = learn.where("label = 1").dropDuplicates(["mark"])
    learn = learn.where("label = 0").unionByName(toxic)
    size = {row["label"]: row["n"] for row in learn.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    counted = learn.select("text", "label").mapInArrow(_count_features, "feature string, label int, n long")
    sums = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    odds = F.log((F.col("t") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(n_clean + 1.0))
    enough = F.col("t") >= max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
    found = sums.where(enough).select("feature", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS).collect()
    insults = {row["feature"]: row["odds"] for row in found}
    measured = apply_grammar(rows.where("last").select("label", "text"), insults, None).select("label", "evidence").collect()
    x = np.asarray([row["evidence"] for row in measured], float)
    y = np.asarray([row["label"] for row in measured], float)
    return insults, fit_logistic(x, y)


def score_toxicity(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score, clauses`` (spans of the matched clauses) per row; null texts are empty and match nothing.

    Rows are scored one by one, whatever their id is; equal texts get equal scores, long ones are read
    whole. An empty table gives no rows; without labels every text gets the score of an unknown one.
    """
    rows = docs.select(F.col(doc_id).alias("id"), full_text(text).alias("text"))
    return apply_grammar(rows, *model).select("id", "score", "clauses")


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with their own columns."""
    model = train_toxicity(docs, labels, doc_id, text)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), full_text(text).alias("body"))
    return apply_grammar(rows, *model).where(F.col("score") < cut).select("row.*")


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_toxicity(docs, labels.where(crc_mod("doc_id", 3) != 1).select("doc_id", "toxic"))
    return score_toxicity(docs, model).select(
        F.col("id").alias("doc_id"),
        (crc_mod("id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        F.size("clauses").alias("matched_clauses"),
    )


BOOK = {"op2_toxicity_grammar": (op2_toxicity_grammar, None)}
