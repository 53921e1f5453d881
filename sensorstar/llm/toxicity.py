"""Toxicity of texts: a classifier that a swapped identity term should not move.

Logistic regression on words, their beginnings and identity terms. Beside the usual
loss, each labelled text that names a group is paired with copies that name another
group of the same kind, and the squared difference of their scores is added: words
for groups lose the weight that only their company gives them.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.llm.common import by_batch, rows_by_batch

# Bounds of the fit: labelled texts of each class, features by their strength.
PER_CLASS = 6000
FEATURES = 512
LEAST_TEXTS = 5
PREFIXES = (3, 4, 5, 6)
RIDGE = 0.1
# Weight of a squared score difference between a text and its counterfactual.
SWAP_PENALTY = 10.0
ROUNDS = 25
REMEMBERED = 100_000

# Words that name groups, by kind; a word is swapped for those beside it.
IDENTITY_TERMS = (
    ("woman", "man"),
    ("women", "men"),
    ("female", "male"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("disabled", "deaf", "blind"),
    ("old", "young"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
)
SWAPS = {term: [o for o in kind if o != term] for kind in IDENTITY_TERMS for term in kind}

WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word itself (``=word``) and its beginnings (``^begin``). A word for a
    group has no beginnings: only its own weight stands for it."""
    if word in SWAPS:
        return [f"={word}"]
    return [f"={word}", *[f"^{word[:n]}" for n in PREFIXES if len(word) >= n]]


@dataclass(frozen=True)
class Model:
    """Weights by feature and a bias; bounded by ``FEATURES`` and the identity terms."""

    weights: dict[str, float]
    bias: float

    def known(self) -> _Known:
        return _Known(self.weights)

    def score(self, text: str | None, known: _Known) -> float:
        hits = set()
        for found in map(known.__getitem__, words_of(text)):
            hits.update(found)
        return sigmoid(self.bias + math.fsum(self.weights[f] for f in hits))


class _Known(dict):
    """The weighted features of each word, up to a bound."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = tuple(f for f in features_of(word) if f in self.weights)
        return found


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _fold(doc_id):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5))


def training_rows(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """``(text, toxic)`` of at most ``per_class`` labelled documents of each class, by
    the order of a hash of the id, never of the held-out fold; and how many labels
    each class has. A document with several labels is toxic if one of them says so."""
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where((_fold("doc_id") != 0) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = [usable.where(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("text", "toxic"), counts


def _strongest(rows: DataFrame, seen: dict[int, int], features: int) -> list[str]:
    """The features whose presence differs most between the classes, by a z-score.
    ``seen``: texts of each class, neither of them 0."""

    def make():
        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for feature in {f for w in words_of(text) for f in features_of(w)}:
                    found.setdefault(feature, [0, 0])[toxic] += 1
            clean, dirty = (pa.array([v[c] for v in found.values()], pa.int64()) for c in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), clean, dirty], ["feature", "clean", "dirty"])

        return count

    counted = by_batch(rows, make, "feature string, clean long, dirty long")
    summed = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("dirty").alias("dirty"))
    enough = summed.where(F.col("clean") + F.col("dirty") >= LEAST_TEXTS)
    rate = (F.col("clean") + F.col("dirty")) / (seen[0] + seen[1])
    spread = F.sqrt(rate * (1 - rate) * (1 / seen[0] + 1 / seen[1]))
    z = F.abs(F.col("dirty") / seen[1] - F.col("clean") / seen[0]) / F.greatest(spread, F.lit(1e-9))
    best = enough.select("feature", F.round(z, 6).alias("z")).orderBy(F.desc("z"), "feature").limit(features)
    return [r["feature"] for r in best.collect()]


def _matrix_rows(rows: DataFrame, features: list[str]) -> DataFrame:
    """Per text: its label, its features as places, and those of its counterfactuals."""
    places = {f: n for n, f in enumerate(features)}

    def make():
        def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, swapped = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                own.append(_places(words, places))
                swapped.append([_places((words - {t}) | {o}, places) for t in sorted(words & SWAPS.keys()) for o in SWAPS[t]])
            kind = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(own, kind), pa.array(swapped, pa.list_(kind))], ["toxic", "own", "swapped"]
            )

        return convert

    return by_batch(rows, make, "toxic int, own array<int>, swapped array<array<int>>")


def _places(words: set[str], places: dict[str, int]) -> list[int]:
    return sorted({places[f] for w in words for f in features_of(w) if f in places})


def _dense(rows: list[list[int]], width: int) -> np.ndarray:
    found = np.zeros((len(rows), width))
    for n, row in enumerate(rows):
        found[n, row] = 1
    return found


def solve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, swaps: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Newton steps on the weighted loss, a ridge and the swap penalty (whose rows are
    differences of features between a text and its counterfactual)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    fixed = np.diag(ridge)
    fixed[:-1, :-1] += 2 * penalty * swaps.T @ swaps

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float(weight @ (np.logaddexp(0, z) - y * z) + beta @ fixed @ beta / 2)

    beta = np.zeros(x.shape[1])
    now = loss(beta)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (weight * (p - y)) + fixed @ beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + fixed
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while (then := loss(beta - size * step)) > now and size > 1e-6:
            size /= 2
        beta, gain, now = beta - size * step, now - then, then
        if gain < 1e-6 * abs(now):
            break
    return beta[:-1], float(beta[-1])


def fit(
    documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES, penalty: float = SWAP_PENALTY
) -> Model:
    """A model from at most ``2 * per_class`` labelled texts outside the held-out fold.

    Without labelled texts of both classes every score is 1 if they are all toxic,
    else 0. Labels that are null or not 0 or 1, and labels of unknown documents, do
    not count. Texts may be null or empty.
    """
    rows, counts = training_rows(documents, labels, per_class)
    rows = rows.persist()
    seen = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if set(seen) != {0, 1}:
        rows.unpersist()
        return Model({}, 1000.0 if seen.get(1) else -1000.0)
    names = sorted({*_strongest(rows, seen, features), *(f"={t}" for t in SWAPS)})
    found = _matrix_rows(rows, names).toPandas().sort_values(["toxic"], kind="stable")
    rows.unpersist()
    y = found["toxic"].to_numpy(float)
    total = counts[0] + counts[1]
    weight = np.array([counts[int(c)] / seen[int(c)] for c in y]) * len(y) / total
    own = [list(r) for r in found["own"]]
    pairs = [(a, list(b)) for a, r in zip(own, found["swapped"], strict=True) for b in r]
    swaps = _dense([a for a, _ in pairs], len(names)) - _dense([b for _, b in pairs], len(names))
    beta, bias = solve(_dense(own, len(names)), y, weight, swaps, penalty)
    return Model({n: float(w) for n, w in zip(names, beta, strict=True) if abs(w) > 1e-9}, bias)


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``documents``, from the
    whole text alone. Null and empty texts score the bias. Ids may be null (never held
    out) or repeat. Other columns are not read."""
    weights, bias = model.weights, model.bias

    def make():
        own = Model(weights, bias)
        known = own.known()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [own.score(t, known) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

        return run

    source = documents.select("doc_id", F.col("text").cast("string"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    scored = by_batch(source, make, f"doc_id {id_type}, score double")
    held_out = F.coalesce(_fold("doc_id") == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` whose text scores below one half, with all columns."""
    weights, bias = model.weights, model.bias

    def make():
        own = Model(weights, bias)
        known = own.known()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            return batch.filter(pa.array([own.score(t, known) < 0.5 for t in texts], pa.bool_()))

        return run

    return rows_by_batch(documents, make)


def toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(documents, fit(documents, labels))
