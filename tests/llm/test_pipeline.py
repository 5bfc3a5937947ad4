"""The pipeline's stages against the operators' brute-force versions, each on its own input."""

import numpy as np
import pytest

import corpus_pipeline
from pledgeflow.llm import toxicity
from pledgeflow.llm.common import table
from pledgeflow.llm.queries import toxicity_model
from tests.llm import cases, test_decontamination, test_lines, test_packing, test_simhash, test_toxicity

SCHEMA = cases.SCHEMA + ", hit_items string, n_dropped string"
LEAK = cases.prose(21, 30)


def rows():
    made = test_toxicity.made(60, 4)
    out = [(1000 + i, t) for i, t, _ in made] + [(r[0], r[1]) for r in cases.rows()]
    shared = "A line that many documents share"
    out += [(2000 + i, f"{shared}\n{cases.prose(300 + i, 40)}\n{shared} ") for i in range(12)]
    out += [(3000 + i, f"{cases.prose(400 + i // 3, 60)}") for i in range(9)]
    out += [(4000, f"{cases.prose(500, 20)} {LEAK} {cases.prose(501, 20)}"), (4001, LEAK.upper())]
    return [(i, t, "en", "s", n, *["own"] * 8) for n, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{root}/documents.parquet")
    labels = [(1000 + i, 1, y) for i, _, y in test_toxicity.made(60, 4)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, LEAK), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_every_stage_on_what_the_one_before_kept(spark, folder, tmp_path):
    docs = table(spark, folder, "documents")
    seen = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, folder)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns and dict(made.dtypes) == dict(docs.dtypes)
            assert made.filter("score <> 'own' or hit_items <> 'own' or n_dropped <> 'own' or fingerprint <> 'own'").count() == 0
        made.write.parquet(f"{tmp_path}/{n}")
        seen[name] = pairs(docs)
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if name == "line_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    scorer = toxicity.Scorer(toxicity_model(table(spark, folder, "documents"), table(spark, folder, "labels")))
    order = lambda xs: sorted(xs, key=str)
    assert order(seen["line_dedup"]) == order(p for p in seen["toxicity"] if scorer(p[1]) < 0.7)
    assert 0 < len(seen["line_dedup"]) < len(seen["toxicity"])
    want = [(i, text) for i, _, _, text in test_lines.brute(seen["line_dedup"], 10)]
    assert order(seen["near_duplicates"]) == order(want)
    codes = [test_simhash.slow_print(t) if not t or len(t) < 5000 else test_simhash.simhash.fingerprint(t) for _, t in want]
    groups = test_simhash.brute(codes)
    least = {}
    for (i, _), g in zip(want, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    kept = seen["decontamination"]
    assert sorted((i for i, _ in kept if i is not None)) == sorted(least.values())
    assert len(kept) == len(set(groups)) < len(want)
    clean = [p for p in kept if not test_decontamination.brute(p[1], [(1, LEAK)], 10)[1]]
    assert order(seen["packing"]) == order(clean) and len(clean) < len(kept)
    ids_of = test_packing.packing.PieceIds(test_packing.PATH)
    lengths = sum(len(np.frombuffer(ids_of(t), "<u2")) + 1 for _, t in clean)
    assert sum(r["length"] for r in docs.select("length").collect()) == lengths


def test_empty_documents_table(spark, folder):
    docs = table(spark, folder, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, folder)
        assert made.count() == 0, name
