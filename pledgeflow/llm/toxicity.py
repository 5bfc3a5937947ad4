"""Toxicity: subword bags averaged into a linear softmax, embeddings and classifier trained together.

A word is the bag of its character n-grams (with word ends) and itself, each
hashed to a row of one embedding table; a text is the average of all its bags and of
a padding row, which keeps very short texts near the prior.
Misspellings and compounds share n-grams with words seen in training, so their
vectors are known. Both layers are trained by AdaGrad in numpy on the driver.

Bounds: training takes at most ``MAX_ROWS`` labelled rows, half of them of each label as
far as there are, in the order of a hash of the id, and of these as many as have
``MAX_CHARS`` code points together. The softmax is then moved to the share of
label 1 among all training rows, and its slope is fitted on rows left out of the training.
Scoring covers every text as a whole.

As the output is linear in the average, a trained model is one number per n-gram
row; a task keeps the sums of the words it has met.

Defined cases: a null or empty text, and one of white space only, is padding alone;
rows without label are not trained on, null labels and null ids neither; repeated rows
are scored one by one, and an id with both labels is trained on with the larger one; without training rows of both labels every score is the share
of label 1 (0 without any); an empty table gives an empty result; columns named
like the added ones are replaced.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from pledgeflow.llm.common import Rows, kept_in_worker, stored, with_columns, words

MAX_ROWS, MAX_CHARS = 6_000, 30_000_000
#: One of so many sampled rows is not trained on: with them the scores are calibrated.
CALIBRATION = 6
THRESHOLD = 0.7
#: Rows of the embedding table, its width, lengths of n-grams.
BUCKETS, WIDTH, NGRAMS = 1 << 17, 8, (3, 4, 5)
EPOCHS, LEAST_STEPS, BATCH, RATE = 12, 300, 64, 1.0
#: Times the row 0 counts in every average, so that a few words alone don't decide.
PADDING = 60
#: Words a Python worker keeps the sums of.
CACHE_WORDS = 350_000


def word_rows(word: bytes) -> list[int]:
    """Rows of a word's n-grams and of the word."""
    marked = f"<{word.decode('utf-8', 'replace')}>"
    grams = [marked] + [marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1)]
    return [1 + crc32(g.encode()) % (BUCKETS - 1) for g in grams]


def _bag(found: list[bytes], known: dict[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a text and their shares in its average."""
    for word in set(found):
        if word not in known:
            known[word] = np.array(word_rows(word), np.uint32).tobytes()
    rows = np.frombuffer(b"".join(map(known.__getitem__, found)), np.uint32)
    at, counts = np.unique(np.concatenate((np.zeros(PADDING, np.uint32), rows)), return_counts=True)
    return at, (counts / (len(rows) + PADDING)).astype(np.float32)


@dataclass
class Model:
    """The part of a trained model that scores: log odds per row, the bias."""

    row_odds: np.ndarray
    bias: float

    def share(self, odds: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def fit(texts: Iterable[str | None], labels: list[int], prior: float, seed: int = 7) -> Model:
    """Train both layers; ``prior`` is the share of label 1 that scores are moved to."""
    y = np.array(labels, np.int64)
    odds = math.log(max(prior, 1e-9) / max(1 - prior, 1e-9))
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), odds)
    known: dict[bytes, bytes] = {}
    bags = [_bag(words(t), known) for t in texts]
    del known
    aside = np.random.default_rng(seed + 1).permutation(len(bags)) % CALIBRATION == 0
    if len(set(y[aside].tolist())) < 2:
        aside[:] = False
    train = np.flatnonzero(~aside)
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, 2), np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full_like(table, 1e-8), np.full_like(out, 1e-8), np.full_like(bias, 1e-8)]
    dense = np.zeros((BATCH, BUCKETS), np.float32)
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(train)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = random.permutation(train)
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            for i, b in enumerate(batch):
                dense[i, bags[b][0]] = bags[b][1]
            x = dense[: len(batch)]
            hidden = x @ table
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            steps = (x.T @ (p @ out.T), hidden.T @ p, p.sum(axis=0))
            for weights, step, squares in zip((table, out, bias), steps, seen):
                squares += step * step
                weights -= rate * step / np.sqrt(squares)
            for i, b in enumerate(batch):
                dense[i, bags[b][0]] = 0
    row_odds, start = table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])
    if not aside.any():
        return Model(row_odds, start + odds - math.log(y[train].mean() / (1 - y[train].mean())))
    kept = np.flatnonzero(aside)
    raw = np.array([start + float(row_odds[bags[b][0]] @ bags[b][1]) for b in kept])
    weights = np.where(y[kept] == 1, prior / y[kept].mean(), (1 - prior) / (1 - y[kept].mean()))
    slope, shift = _calibrated(raw, y[kept], weights)
    return Model(row_odds * np.float32(slope), slope * start + shift)


def _calibrated(raw: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds that fit weighted labels best, by Newton's method; both kept near (1, 0)."""
    at = np.array([1.0, 0.0])
    x = np.stack((raw, np.ones_like(raw)), axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = x.T @ (weights * (p - y)) + 0.1 * (at - (1.0, 0.0))
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        at = at - np.linalg.solve(curve, step)
        at[0] = min(10.0, max(0.1, at[0]))
    return float(at[0]), float(at[1])


class Scorer:
    """Scores texts; keeps the sums of words between texts."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, text: str | None) -> float:
        found = words(text)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(found):
            if word not in known:
                rows = word_rows(word)
                known[word] = (float(self.model.row_odds[rows].sum()), len(rows))
        sums = np.array([(float(self.model.row_odds[0]) * PADDING, PADDING), *(known[w] for w in found)]).sum(axis=0)
        return self.model.share(self.model.bias + sums[0] / sums[1])


def _scorer(key: str, shared) -> Scorer:
    """The scorer of a Python worker, kept between its tasks."""
    return kept_in_worker("scorer", key, lambda: Scorer(shared.value))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "label") -> Model:
    """A model from documents (id, text) and labels (id, label 0 or 1). Runs when called.

    Only ids, lengths and hashes are shuffled; the texts of the sample are then picked from one scan.
    """
    hashed = F.xxhash64(F.col(id).cast("string"), F.col(text))
    sizes = docs.select(F.col(id), hashed.alias("__order"), F.length(F.coalesce(text, F.lit(""))).alias("__n"))
    marks = labels.filter(F.col(label).isin(0, 1)).select(F.col(id), F.col(label).cast("int").alias("__label"))
    rows = stored(sizes.join(marks, id).select("__order", "__n", "__label"), "labelled")
    counts = {r[0]: r[1] for r in rows.groupBy("__label").count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return fit([], [], prior)
    chosen: dict[int, int] = {}
    for value in (0, 1):
        held = 0
        own = rows.filter(F.col("__label") == value).groupBy("__order").agg(F.max("__n").alias("__n"))
        for r in own.orderBy("__order").limit(MAX_ROWS // 2).collect():
            if held + r["__n"] <= MAX_CHARS // 2:
                held += r["__n"]
                chosen[r["__order"]] = value
    wanted = docs.sparkSession.createDataFrame(sorted(chosen.items()), "__order long, __label int")
    found = docs.select(hashed.alias("__order"), F.col(text)).join(F.broadcast(wanted), "__order").dropDuplicates(["__order"])
    sample = {r["__order"]: (r[text], r["__label"]) for r in found.collect()}
    texts, values = zip(*(sample[k] for k in sorted(sample)))
    return fit(texts, list(values), prior)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    added = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def start() -> Callable[[pa.RecordBatch], Rows]:
        scorer = _scorer(key, shared)

        def convert(batch: pa.RecordBatch) -> Rows:
            scores = [scorer(t) for t in batch.column(text).to_pylist()]
            return {"score": scores, "predicted": [int(s >= threshold) for s in scores]}

        return convert

    return with_columns(docs, added, start)
