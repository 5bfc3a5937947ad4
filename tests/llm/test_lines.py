"""Line dedup against counting in Python; insertions and deletions; the cuckoo filter."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pledgeflow.llm import lines
from tests.llm.cases import docs_of, empty, frame


def key(line, least=1):
    k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    return k if len(k) >= max(1, least) else None


def brute(docs, min_docs, least=1):
    n = Counter(k for _, t in docs for k in {key(x, least) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in docs:
        old = (t or "").split("\n")
        new = [x for x in old if not (n.get(key(x, least), 0) >= min_docs)]
        out.append((i, len(old), len(old) - len(new), "\n".join(new)))
    return sorted(out, key=str)


DOCS = [(i, "\n".join([f"own {i}", "  Shared line\t", f"pair {i // 2}", "", "é" if i % 3 else "É"])) for i in range(12)] + [
    (20, None), (21, ""), (22, "SHARED LINE\nshared line\n\n"), (22, "shared line"), (22, "shared line"), (None, "shared line\nlast"), (23, "\n\n"),
    (24, "pair 1\n" + "long " * 40_000),
]


def result(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=str)


def test_dropped_lines_are_those_counted(spark):
    docs = docs_of(spark, DOCS).repartition(3)
    for min_docs, least in ((10, 1), (3, 1), (2, 5)):
        assert result(lines.drop_common_lines(docs, min_docs=min_docs, min_chars=least)) == brute(DOCS, min_docs, least)


def test_keys_beyond_the_hot_list_go_through_the_filters(spark, monkeypatch):
    for hot in (1, 12, 10_000):
        monkeypatch.setattr(lines, "HOT_LINES", hot)
        made = lines.drop_common_lines(docs_of(spark, DOCS), min_docs=3, shard_lines=7)
        assert result(made) == brute(DOCS, 3)


def test_kept_filters_judge_as_rebuilt_ones(spark):
    shards, first, second = 3, docs_of(spark, DOCS[:9]), docs_of(spark, DOCS[9:])
    one = lines.count_lines(first)
    both = lines.insert(one, second)
    filters = lines.build_filters(one, shards, 3)
    grown = lines.update_filters(filters, one, both, shards, 3)
    shrunk = lines.update_filters(grown, both, lines.delete(both, second), shards, 3)
    judged = lambda counts, kept: result(lines.drop_common_lines(first, counts, min_docs=3, filters=kept, shards=shards))
    assert judged(both, grown) == result(lines.drop_common_lines(first, both, min_docs=3))
    assert judged(one, shrunk) == judged(one, filters) == brute(DOCS[:9], 3)
    # filters decide: what they don't know is not dropped, whatever the counts say
    assert all(r[2] == 0 for r in judged(both, filters.limit(0)))
    with pytest.raises(ValueError):
        lines.drop_common_lines(first, filters=filters)


def test_every_common_key_of_a_small_table_meets_a_filter(spark, monkeypatch):
    """The probe sees all lines; nothing is decided from the broadcast list."""
    seen = []
    plain = lines._lines

    def watched(docs, id, text, min_chars, decided, shards):
        seen.append(dict(decided.value))
        return plain(docs, id, text, min_chars, decided, shards)

    monkeypatch.setattr(lines, "_lines", watched)
    assert result(lines.drop_common_lines(docs_of(spark, DOCS), min_docs=10)) == brute(DOCS, 10)
    assert seen == [{}]


def test_deletion_undoes_insertion(spark):
    first, second = docs_of(spark, DOCS[:9]), docs_of(spark, DOCS[9:])
    bag = lambda df: sorted((bytes(r["key"]), r["n"]) for r in df.collect())
    one = lines.count_lines(first)
    both = lines.insert(one, second)
    assert bag(both) == bag(lines.count_lines(docs_of(spark, DOCS)))
    assert bag(lines.delete(both, second)) == bag(one)
    kept = lines.drop_common_lines(first, counts=both, min_docs=10)
    assert {r["n_dropped"] for r in kept.collect()} == {1}


def test_filters_follow_the_counts(spark):
    shards = 3
    before = lines.count_lines(docs_of(spark, DOCS[:9]))
    after = lines.count_lines(docs_of(spark, DOCS))

    def known(filters, counts):
        held = {r["shard"]: lines.CuckooFilter.from_bytes(r["filter"]) for r in filters.collect()}
        keys = [bytes(r["key"]) for r in counts.filter("n >= 3").collect()]
        return all(held[s].contains(lines._hashes([k]))[0] for k, s in zip(keys, lines._shards(keys, shards)))

    filters = lines.build_filters(before, shards, 3)
    assert known(filters, before)
    grown = lines.update_filters(filters, before, after, shards, 3)
    assert known(grown, after)
    back = lines.update_filters(grown, after, before, shards, 3)
    sizes = lambda f: sum(int((lines.CuckooFilter.from_bytes(r["filter"]).table > 0).sum()) for r in f.collect())
    assert known(back, before) and sizes(back) == sizes(filters)


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.integers(0, 300))
def test_cuckoo_filter_holds_and_forgets(keys, gone):
    keys = sorted(keys)
    held = lines.CuckooFilter.of(np.array(keys, np.uint64))
    assert held.contains(np.array(keys, np.uint64)).all()
    for k in keys[:gone]:
        assert held.delete(k)
    assert held.contains(np.array(keys[gone:], np.uint64)).all()
    assert int((held.table > 0).sum()) == len(keys[gone:])
    full = lines.CuckooFilter(capacity=4)
    took = [k for k in keys if full.insert(k)]
    assert full.contains(np.array(took, np.uint64)).all()


def test_awkward_rows_and_empty_tables(spark):
    docs = frame(spark)
    made = lines.drop_common_lines(docs, min_docs=2)
    assert made.count() == docs.count() and set(docs.columns) <= set(made.columns)
    assert made.filter("source <> 's' or fingerprint <> 'own'").count() == 0
    assert lines.drop_common_lines(empty(spark)).count() == 0
