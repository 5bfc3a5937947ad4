"""Collocations against counting every phrase; transducers against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pledgeflow.llm import collocations as C
from pledgeflow.llm.common import FEW_BYTES
from pledgeflow.session import settings
from tests.llm.cases import empty, frame, rows

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, score string, rank string, n string"


def phrases(texts):
    found = Counter()
    for text in texts:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                found.update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    return found


def brute(docs, min_count=10, share=50, top=2000):
    by_lang, out = {}, []
    for lang, text in docs:
        by_lang.setdefault("und" if lang is None else lang, []).append(text)
    for lang, texts in by_lang.items():
        f = phrases(texts)
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= share * a for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed, n):
    r = random.Random(seed)
    words = ["a", "b", "C", "d'e", "é", "\x01", "\U0001f600", "of", "the", "x-y"] + [f"w{i}" for i in range(40)]
    out = []
    for i in range(n):
        own = r.choices(words, weights=[1 + 90 // (j + 1) for j in range(len(words))], k=r.randint(0, 60))
        out.append("".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in own))
    return [(r.choice(["en", "en", "en", "de", None, ""]), t) for t in out]


def made_from(found):
    words = sorted({w for p in found for w in p})
    number = {w: n for n, w in enumerate(words, 1)}
    grams = []
    for size in (1, 2, 3):
        own = sorted((sum(number[w] << C.BITS * (size - 1 - i) for i, w in enumerate(p)), n) for p, n in found.items() if len(p) == size)
        grams.append((np.array([k for k, _ in own], np.int64), np.array([n for _, n in own], np.int64)))
    return C.Automaton.of(words, grams)


def as_dict(made):
    return {p: n for size, (k, c) in enumerate(made.grams(), 1) for p, n in zip(made.phrases(k, size), c.tolist())}


def random_phrases(seed, n):
    r = random.Random(seed)
    return {tuple(b"%d" % r.randrange(12) for _ in range(r.randint(1, 3))): r.choice([1, 2, 1 << 45]) for _ in range(n)}


@pytest.mark.parametrize("run", [3, 1 << 17])
@pytest.mark.parametrize("n", [0, 1, 400])
def test_transducers_hold_what_they_were_built_from(monkeypatch, run, n):
    monkeypatch.setattr(C.Automaton, "RUN", run)
    found = random_phrases(n, n)
    made = C.Automaton.from_bytes(made_from(found).to_bytes())
    assert as_dict(made) == found
    asked = [*found, (b"0",), (b"0", b"no"), (b"no", b"0", b"1"), (b"11", b"11", b"11")]
    assert made.compose(asked).tolist() == [found.get(p, 0) for p in asked]


def test_states_with_the_same_arcs_are_kept_once():
    found = {(b"%d" % i, b"%d" % j, b"end"): 1 for i in range(30) for j in range(30)}
    levels = made_from(found).levels
    assert [len(level.label) for level in levels] == [30, 30, 1]


def test_union_and_slices(monkeypatch):
    several = [random_phrases(i, 300) for i in range(5)]
    total = Counter()
    for found in several:
        total.update(found)
    borders = sorted(("en", p) for p in list(several[0])[:9] + [(b"nowhere", b"0"), (b"0",)]) + [("fr", (b"1",))]
    borders = [("de", (b"5",)), *borders]
    by_range = {}
    for found in several:
        for n, part in C.sliced(made_from(found), "en", borders):
            by_range.setdefault(n, []).append(part)
    whole = {}
    for n, slices in by_range.items():
        own = as_dict(C.united(slices))
        monkeypatch.setattr(C, "_MASK", 5)  # as if the words were too many to number
        by_words = C._united_by_words if n % 2 else None
        monkeypatch.undo()
        assert by_words is None or as_dict(by_words(slices, 1)) == own
        for p in own:
            assert sum(b <= ("en", p) for b in borders) == n
        whole |= own
    assert whole == total
    assert as_dict(C.united([made_from(f) for f in several], 3)) == {p: n for p, n in total.items() if n >= 3}


@pytest.mark.parametrize("shard_words,ranges", [(50, 40), (4_000_000, 1 << 20)])
def test_all_phrases(spark, shard_words, ranges):
    docs = texts(1, 400) + [("en", " ".join(["the", "of"] * 3000)), ("fr", "un deux trois! " * 11), (None, None), ("xx", "")]
    df = spark.createDataFrame([(i, t, g, "own", "own", "own") for i, (g, t) in enumerate(docs)], SCHEMA).repartition(5)
    made = C.find_collocations(df, min_count=10, top=60, range_entries=ranges, shard_words=shard_words)
    assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(docs, top=60)
    assert sorted(map(tuple, made.collect())) == want and len(want) > 90


def test_awkward_documents_and_empty_tables(spark):
    docs = [(r[2], r[1]) for r in rows()]
    made = C.find_collocations(frame(spark), min_count=2)
    assert sorted(map(tuple, made.collect())) == brute(docs, 2)
    assert C.find_collocations(empty(spark)).count() == 0


def test_only_words_of_entries_that_stay_are_sorted(monkeypatch):
    texts = [" ".join(f"rare{n}x{i} often" for i in range(200)) for n in range(3)]
    slices, lengths = [_automaton(t) for t in texts], []
    monkeypatch.setattr(C, "sorted", lambda x, **how: lengths.append(len(list(x))) or sorted(x, **how), raising=False)
    made = C.united(slices, 10)
    assert made.words == [b"often"] and made.grams()[0][1].tolist() == [600]
    assert max(lengths) <= 1


def test_united_is_the_automaton_of_all_texts():
    texts = ["b a b c. a b", "", "c b a, a b c a b", "d d d d"]
    all_at_once = _automaton(". ".join(texts))
    assert C.united([_automaton(t) for t in texts]).to_bytes() == all_at_once.to_bytes()
    some = C.united([_automaton(t) for t in texts], 3)
    for (keys, counts), size, (every, n) in zip(some.grams(), (1, 2, 3), all_at_once.grams()):
        want = [(p, c) for p, c in zip(all_at_once.phrases(every, size), n.tolist()) if c >= 3]
        assert list(zip(some.phrases(keys, size), counts.tolist())) == want
    assert C.united([]).words == []


def _automaton(text):
    found, ids = [*C.pieces(text), b"."], C._Ids({b".": 0})
    return C.counted(ids, [np.array([ids[w] for w in found], np.int32)])


def test_shards_are_stored_and_read_a_few_at_a_time(spark, monkeypatch):
    def rows(batches):
        for batch in batches:
            for n in batch.column("id").to_pylist():
                data = np.random.default_rng(n).bytes(1 << 20)
                yield pa.RecordBatch.from_pydict({"n": [n], "data": [data]})

    folders = []
    real = C.stored

    def spied(df, name, **options):
        out = real(df, name, **options)
        folders.append((name, out.inputFiles()))
        return out

    monkeypatch.setattr(C, "stored", spied)
    monkeypatch.setattr(C, "shards", lambda *_: spark.range(60, numPartitions=1).mapInArrow(rows, "n long, data binary"))
    with pytest.raises(Exception):  # these are no shards, and what follows fails
        C.find_collocations(spark.createDataFrame([("a", "en")], "text string, lang string"))
    (name, files), key = folders[0], "spark.sql.execution.arrow.maxBytesPerBatch"
    assert name == "phrase-shards" and len(files) == 1
    made = pq.ParquetFile(files[0].removeprefix("file:")).metadata
    sizes = [made.row_group(n).total_byte_size for n in range(made.num_row_groups)]
    assert sum(sizes) > 60 << 20 and max(sizes) < 34 << 20
    was = spark.conf.get(key)
    with settings(spark, FEW_BYTES):
        assert int(spark.conf.get(key)) == 16 << 20
        read = spark.read.parquet(*files).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"rows": [b.num_rows]}) for b in bs), "rows long")
        assert max(r["rows"] for r in read.collect()) <= 17
    assert spark.conf.get(key) == was


def test_small_slices_have_only_their_words():
    words = [b"w%04d" % n for n in range(2000)]
    whole = C.Automaton.of(words, [(np.arange(1, 2001), np.ones(2000, np.int64)), *[C._NO_GRAMS] * 2])
    made = dict(C.sliced(whole, "en", [("en", (b"w0007",)), ("en", (b"w0009",))]))
    assert [len(made[n].words) for n in range(3)] == [7, 2, 1991]
    assert made[1].words == [b"w0007", b"w0008"] and made[1].grams()[0][1].tolist() == [1, 1]
    once = iter([made[0], made[1]])
    assert C.united(once).words == words[:9]  # read one at a time
