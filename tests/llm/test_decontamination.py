"""Windows of the benchmark in documents, against a search for every window."""

import re

import pytest

from pledgeflow.llm import decontamination
from tests.llm.cases import docs_of, empty, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, size):
    found = WORD.findall(lower(text))
    hit, names = set(), set()
    for item, of in items:
        words = WORD.findall(lower(of))
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            for j in range(len(found) - n + 1):
                if found[j : j + n] == words[i : i + n]:
                    hit |= set(range(j, j + n))
                    names.add("null" if item is None else str(item))
    return len(found), sorted(hit), sorted(names)


ITEMS = [(1, prose(21, 30)), (2, prose(22, 10)), (3, "Short-One, é"), (4, ""), (5, None), (None, prose(23, 12)), (1, prose(21, 30)), (6, "same same same same")]
DOCS = [
    (1, prose(30, 50) + " " + prose(21, 30).upper() + " " + prose(31, 20)),
    (2, " ".join(prose(22, 10).split()[:9])),
    (3, "x short one É é short ONE é"),
    (4, "same " * 30),
    (5, None),
    (6, ""),
    (7, prose(23, 12) + " " + prose(23, 12)),
    (7, prose(23, 12)),
    (8, "y".join(["z" * 1000] * 100)),
    (9, " ".join(prose(21, 30).split()[3:25])),
]


@pytest.mark.parametrize("size,block", [(10, 500_000), (10, 15), (3, 40)])
def test_hits_are_those_of_a_full_search(spark, size, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.find_leaks(docs_of(spark, DOCS), bench, size=size, block_words=block).collect()
    assert len(got) == len(DOCS)
    made = sorted(
        (r["doc_id"], r["n_words"], [w for s in r["hit_spans"] for w in range(s["start"], s["end"])], r["hit_items"]) for r in got
    )
    assert made == sorted((i, *brute(t, ITEMS, size)) for i, t in DOCS)
    assert any(m[2] for m in made) and any(not m[2] for m in made)


def test_awkward_rows_and_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark)
    found = decontamination.find_leaks(docs, bench)
    assert found.count() == docs.count() and dict(found.dtypes)["n_words"] == "bigint"
    kept = decontamination.without_leaks(docs, bench)
    assert kept.schema == docs.schema and kept.filter("n_words <> 'own'").count() == 0
    assert decontamination.find_leaks(docs, bench.limit(0)).filter("size(hit_spans) > 0").count() == 0
    assert decontamination.find_leaks(empty(spark), bench).count() == 0
