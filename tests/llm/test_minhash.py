"""Fingerprints against exact similarity; the following document against sorting in Python."""

import random

from pyspark.sql import functions as F

from pledgeflow.llm import minhash
from tests.llm.cases import docs_of, empty, frame, prose


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_is_near_the_exact_one_without_bias(spark):
    r = random.Random(3)
    pairs = []
    for n in range(240):
        words = prose(100 + n, r.choice([20, 60, 200, 900])).split()
        cut = int(len(words) * r.random())
        pairs.append((n, " ".join(words), " ".join(words[:cut] + prose(900 + n, len(words) - cut).split())))
    df = spark.createDataFrame(pairs, "n long, a string, b string").repartition(8)
    got = df.select("n", minhash.likeness(minhash.fingerprint(F.col("a")), minhash.fingerprint(F.col("b"))).alias("near"))
    off = [x["near"] - jaccard(*pairs[x["n"]][1:]) for x in got.collect()]
    assert abs(sum(off) / len(off)) < 0.01 and max(map(abs, off)) < 0.15


def test_following_documents_edits_and_equal_texts(spark):
    docs = [(i * 7 % 101, prose(i, i % 40)) for i in range(101)] + [(500, prose(7, 30)), (501, prose(7, 30))]
    ordered = sorted(docs)
    follower = {ordered[n][0]: ordered[(n + 1) % len(ordered)][1] for n in range(len(ordered))}
    texts = dict(docs)
    got = minhash.edited_pairs(docs_of(spark, docs).repartition(5)).collect()
    assert len(got) == len(docs)
    for r in got:
        own, half = texts[r["doc_id"]], len(texts[r["doc_id"]]) // 2
        want = own[: len(own) - half] + follower[r["doc_id"]][:half]
        assert r["edited"] == want and r["n_chars"] == len(own)
        assert abs(r["near_next"] - jaccard(own, follower[r["doc_id"]])) < 0.15
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[500] == prints[501] and len(prints[500]) == minhash.BINS // 8


def test_awkward_rows_and_empty_tables(spark):
    docs = frame(spark)
    got = minhash.edited_pairs(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    blank = [r for r in got if r["doc_id"] in (0, 1, 2)]
    assert all(r["fingerprint"] == [] for r in blank) and blank[0]["near_edited"] in (0.0, 1.0)
    assert minhash.edited_pairs(empty(spark)).count() == 0
    one = minhash.edited_pairs(docs_of(spark, [(1, "a b c d")])).first()
    assert one["edited"] == "a b a b"[:4] + "a b" and one["near_next"] == 1.0


def test_no_python_in_the_plan(spark):
    text = minhash.edited_pairs(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
