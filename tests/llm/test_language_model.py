"""Counts and base scores against Python; the model's probabilities add up to one; training lowers the loss."""

import math
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pledgeflow.llm import language_model as lm
from pledgeflow.llm.common import words
from tests.llm.cases import docs_of, empty, frame, prose, rows

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


HELD_OUT = "crc32(cast(doc_id AS string)) % 7 = 2"


@pytest.fixture(scope="module", autouse=True)
def short_training():
    saved = lm.STEPS, lm.FREQUENT_SHARE
    lm.STEPS, lm.FREQUENT_SHARE = 20, 50
    lm.CACHE_WORDS, saved_cache = 200, lm.CACHE_WORDS
    lm.fit.__defaults__ = (20, *lm.fit.__defaults__[1:])
    yield
    lm.STEPS, lm.FREQUENT_SHARE = saved
    lm.CACHE_WORDS = saved_cache
    lm.fit.__defaults__ = (saved[0], *lm.fit.__defaults__[1:])


def weights(size=100, seed=3):
    random = np.random.default_rng(seed)
    w = lm.fresh(lm.Counted.of(random.integers(0, 5, (size, size)).astype(float)))
    w.group[:] = random.standard_normal(w.group.shape) * 0.3
    w.inside[:] = random.standard_normal(w.inside.shape) * 0.3
    return w


def test_probabilities_add_up_to_one_and_do_not_look_ahead():
    size, w = 100, weights()
    scorer = lm.Scorer(w)
    history = np.random.default_rng(1).integers(0, size - 1, 75).astype(np.int32)
    for n in (0, 5, 31, 32, 70):
        base = scorer([history[:n]], size - 1)[0] if n else 0.0
        after = scorer([np.append(history[:n], i).astype(np.int32) for i in range(size)], size - 1)
        assert (10 ** (after - base)).sum() == pytest.approx(1, abs=1e-3)


def test_score_does_not_depend_on_neighbours():
    scorer, random = lm.Scorer(weights()), np.random.default_rng(2)
    texts = [random.integers(0, 99, n).astype(np.int32) for n in (1, 7, 32, 33, 64, 200)]
    assert scorer(texts, 99) == pytest.approx(np.concatenate([scorer([t], 99) for t in texts]), rel=1e-4)
    assert len(scorer([], 99)) == 0


def test_gradients_are_those_of_small_steps():
    w, random = weights(), np.random.default_rng(4)
    inputs, targets, _, first = lm.windows([random.integers(0, 99, 300).astype(np.int32)], 99)
    batch = inputs[~first][:6], targets[~first][:6], False
    _, steps = lm._gradients(w, *batch)
    for value, step in zip(w.trained, steps):
        at = np.unravel_index(np.abs(step).argmax(), step.shape)
        was, losses = value[at], []
        for move in (0.01, -0.01):
            value[at] = was + np.float32(move)
            losses.append(lm._gradients(w, *batch)[0])
        value[at] = was
        assert (losses[0] - losses[1]) / 0.02 == pytest.approx(step[at], rel=0.1, abs=2e-3)


def test_training_learns_what_pairs_do_not_show():
    ids = np.array(([1, 5, 2] * 40 + [3, 5, 4] * 40) * 6, np.int32)
    counts = np.zeros((10, 10))
    for a, b in zip(ids, ids[1:]):
        counts[a, b] += 1
    w = lm.fresh(lm.Counted.of(counts))
    before = lm.Scorer(w)([ids], 9)[0]
    after = lm.Scorer(lm.fit([ids], w, 9, steps=150))([ids], 9)[0]
    assert after > 0.6 * before


def test_subwords_give_back_the_words():
    ids_of = lm.Subwords(PATH, PATTERN)
    for text in (prose(1, 200), "a\xa0 \xa0b x\u3000y it's 12,5 é" * 3, "", "\xa0"):
        found = words(text)
        ids = ids_of(found)
        assert ids[-1] == ids_of.end
        assert ids_of.encoding.decode_bytes(ids[:-1].tolist()) == b"".join(b" " + w for w in found)


def test_base_scores_and_counts(spark):
    docs = frame(spark)
    got = lm.score_texts(docs.repartition(3), F.expr(HELD_OUT), PATH, PATTERN).collect()
    counts = Counter(w for i, t, *_ in rows() if not held_out(i) for w in [*words(t), b""])
    total, floor = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    want = sorted(
        (str(i), held_out(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), b""]), total,
         round(sum(math.log10((counts[w] + 1) / floor) for w in [*words(t), b""]), 4))
        for i, t, *_ in rows()
    )
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names), round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_pairs_cover_every_training_text(spark):
    docs = docs_of(spark, [(i, prose(i, 30)) for i in range(20)]).withColumn("held_out", F.col("doc_id") == 3)
    ids_of = lm.Subwords(PATH, PATTERN)
    want = Counter()
    for i in range(20):
        for word in words(prose(i, 30)) if i != 3 else []:
            ids = ids_of([word]).tolist()
            want.update(a * ids_of.size + b for a, b in zip([ids_of.end, *ids], ids))
    made = lm.pair_counts(lm.word_counts(docs.repartition(4)), lambda: lm.Subwords(PATH, PATTERN))
    assert {r["pair"]: r["n"] for r in made.collect()} == dict(want)
    shares = lm.counted(pa.table({"pair": list(want), "n": list(want.values())}), 19, ids_of.size)
    assert np.exp(shares.group).sum(axis=1) == pytest.approx(np.ones(ids_of.size), abs=1e-4)
    assert np.exp(shares.inside[shares.group > -30]).sum(axis=1) == pytest.approx(1, abs=1e-3)


def test_numbers_of_any_size_give_finite_scores():
    w = weights()
    for value in (w.query, w.group, w.inside):
        value *= 300
    assert np.isfinite(lm.Scorer(w)([np.arange(90, dtype=np.int32)], 99)).all()


def test_empty_tables_and_no_training_rows(spark):
    assert lm.score_texts(empty(spark), F.expr(HELD_OUT), PATH, PATTERN).count() == 0
    row = lm.score_texts(docs_of(spark, [(1, "a b")]), F.lit(True), PATH, PATTERN).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"], row["base_score"]) == (0, 0, 3, 0.0)


#: Taken before the fixture shortens training.
DEALT_STEPS = lm.fit.__defaults__[0]


def test_weights_are_trained_for_all_steps(monkeypatch):
    w, steps = lm.fresh(lm.Counted.of(np.ones((9, 9)))), []
    monkeypatch.setattr(lm, "_gradients", lambda w, *_: (steps.append(1) or 0.0, [np.zeros_like(v) for v in w.trained]))
    lm.fit([np.arange(9)], w, 8, steps=DEALT_STEPS)
    assert len(steps) == 1500


def test_weights_are_learned_from_all_training_texts(spark, monkeypatch):
    """Without a sample: of two corpora of the same words, that in whose order a text stands predicts it better."""
    monkeypatch.setattr(lm, "FIT_TEXTS", 0)
    random, got = np.random.default_rng(6), []
    line = prose(1, 12).split()
    for shuffled in (False, True):
        texts = [[*line] * 150 for _ in range(60)]
        for text in texts if shuffled else []:
            random.shuffle(text)
        docs = docs_of(spark, [(i, " ".join(t)) for i, t in enumerate(texts)] + [(99, " ".join(line * 9))]).coalesce(2)
        got.append(lm.score_texts(docs, F.col("doc_id") == 99, PATH, PATTERN).filter("doc_id = 99").first())
    assert got[0]["base_score"] == got[1]["base_score"]
    assert got[0]["score"] > got[1]["score"] + 1


def test_a_pass_takes_each_training_id_once_and_averages_the_tasks(spark):
    ids_of = lm.Subwords(PATH, PATTERN)
    texts = [prose(i, 5 + 60 * i) for i in range(9)]
    start = lm.fresh(lm.Counted.of(np.ones((ids_of.size, ids_of.size))))
    shared = spark.sparkContext.broadcast((start, [], np.zeros(0), np.zeros(0, bool)))
    docs = docs_of(spark, list(enumerate(texts))).repartition(3)
    made, n = lm.learned(docs, start, lambda: lm.Subwords(PATH, PATTERN), shared, "a test")
    want, total = 0, 0
    for part in docs.select("text").rdd.glom().collect():
        lesson = lm.Lesson(start, ids_of.end)
        lesson([ids_of(words(r["text"])) for r in part])
        lesson.rest()
        want, total = want + lesson.ids * np.concatenate([v.ravel() for v in lesson.w.trained]).astype(float), total + lesson.ids
    assert n == total == sum(len(ids_of(words(t))) for t in texts)
    got = np.concatenate([v.ravel() for v in made.trained])
    assert got == pytest.approx(want / total, abs=1e-5)
    assert np.abs(got - np.concatenate([v.ravel() for v in start.trained])).max() > 1e-5
    assert lm.learned(docs.limit(0), start, lambda: ids_of, shared, "a test") == (start, 0)


FAULTS = """
import resource
import numpy as np
from pledgeflow.llm import language_model as lm
w = lm.fresh(lm.Counted.of(np.ones((100, 100))))
text = np.random.default_rng(1).integers(0, 99, 20_000).astype(np.int32)
lm.fit([text], w, 99, steps=20)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
lm.fit([text], w, 99, steps=50)
print((resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before) / 50)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="how freed memory is kept depends on the allocator")
def test_steps_of_training_use_the_same_memory_again():
    folder = Path(lm.__file__).parents[2]
    made = subprocess.run([sys.executable, "-c", FAULTS], cwd=folder, capture_output=True, text=True, check=True)
    assert float(made.stdout) < 500
