"""The corpus pipeline: stages that read the documents the one before has kept.

Each stage takes whole documents of any columns, of which it needs doc_id and text,
and returns the same columns, but for the last one. Columns named like those an operator adds
are kept. Nulls, empty texts, repeated rows and empty tables: as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.llm import decontamination, lines, packing, simhash, toxicity
from pledgeflow.llm.common import set_aside, stored, table
from pledgeflow.llm.queries import tokenizer_path, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labelled documents among ``docs``."""
    model = toxicity_model(docs, table(spark, folder, "labels"))
    renamed, back = set_aside(docs, {"score", "predicted"})
    return back(toxicity.score(renamed, model).filter("predicted = 0"))


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines that ten documents share go from all of them; a document may become empty."""
    renamed, back = set_aside(docs, {"n_lines", "n_dropped"})
    kept = lines.drop_common_lines(renamed)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return back(kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents whose fingerprints link (3-word shingles, at most 3 bits) the one with the smallest id stays."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.without_leaks(docs, table(spark, folder, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of token sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A trained model, SimHash links and a tokenizer are not for SQL; the tests have a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name)
    return docs
