"""Fingerprints bit by bit; components against comparing all pairs."""

import random

import pytest
import xxhash

from pledgeflow.llm import simhash
from tests.llm.cases import docs_of, empty, frame, prose, texts


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(codes, radius=3):
    """Smallest index reachable, by repeated comparison of all pairs."""
    least = list(range(len(codes)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a ^ b).bit_count() <= radius and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


@pytest.mark.parametrize("text", [*(t for t in texts() if not t or len(t) < 5000), prose(9, 2000)])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_print(text)


def codes_with_chains(n, seed=1):
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n)]
    for start in out[:10]:
        for length in range(r.randint(1, 12)):
            for _ in range(r.randint(1, 4)):
                start ^= 1 << r.randrange(64)
            out.append(start)
    dense = r.getrandbits(64)
    out += [dense ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(60)]
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("tree_rows", [50_000, 8])
def test_components_are_those_of_all_pairs(spark, tree_rows):
    codes = codes_with_chains(150)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fingerprint long").repartition(5)
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(df, tree_rows=tree_rows)).collect()}
    got = [roots.get(c, c) for c in signed]
    want = brute(codes)
    assert len(set(want)) < len(codes) - 40
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert all(root <= c for c, root in zip(signed, got))


def test_links_grow_with_members_not_with_pairs(spark):
    near = [(1 << a | 1 << b) for a in range(64) for b in range(a)]
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in near], "fingerprint long")
    links = simhash.near_links(df)
    assert links.count() <= 10 * len(near)
    assert simhash.components(links).select("root").distinct().count() == 1


def test_documents_get_the_smallest_id(spark):
    docs = [(10 + i, prose(i % 7, 80)) for i in range(30)] + [(3, None), (2, ""), (1, " \n"), (None, prose(0, 80)), (40, prose(50, 60)), (40, prose(51, 60))]
    got = simhash.near_duplicates(docs_of(spark, docs)).collect()
    codes = [slow_print(t) for _, t in docs]
    group = brute(codes)
    least = {}
    for (i, _), g in zip(docs, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, codes[n], least[group[n]]) for n, (i, _) in enumerate(docs)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in got), key=str) == want


def test_one_of_each_group_stays(spark):
    docs = frame(spark)
    kept = simhash.one_of_each(docs)
    assert kept.schema == docs.schema and kept.filter("fingerprint <> 'own'").count() == 0
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and 6 not in ids and ids.count(9) == 2 and ids.count(0) == 1 and 1 not in ids and 2 not in ids
    assert ids.count(None) == 1
    nameless = docs_of(spark, [(None, prose(1, 30)), (None, prose(2, 30)), (None, prose(2, 30))])
    assert simhash.one_of_each(nameless).count() == 2
    assert simhash.one_of_each(empty(spark)).count() == 0 and simhash.near_duplicates(empty(spark)).count() == 0


def test_one_of_each_sends_a_text_to_python_once(spark, monkeypatch):
    sent, marked = [], simhash._marked
    monkeypatch.setattr(simhash, "_marked", lambda rows, *rest: sent.append(rows.columns) or marked(rows, *rest))
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y"), (3, None, "z")], "doc_id long, text string, more string")
    assert sorted(simhash.one_of_each(docs).collect()) == [(1, "a b c d", "x"), (3, None, "z")]
    assert sent == [["__id", "__text"], ["__row"]]
