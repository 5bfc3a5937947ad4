"""One registered query per operator, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.llm import chat, collocations, decontamination, hard_negatives, language_model, lines, minhash, packing, pii, simhash, token_files, toxicity, urls
from pledgeflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(job: Query) -> Query:
    QUERIES[job.__name__] = job
    return job


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations 2n and 2n + 1 as chosen and rejected of pair n."""
    turns = table(spark, folder, "conversations").withColumn("pair_id", F.expr("conv_id div 2"))
    odd = F.col("conv_id") % 2 != 0
    pairs = chat.format_pairs(turns.filter(~odd), turns.filter(odd))
    runs = {
        c: F.array_join(F.transform(c, lambda m: F.concat_ws(":", m["length"], m["loss"].cast("int"))), ",")
        for c in ("chosen_mask", "rejected_mask")
    }
    return pairs.withColumns(runs)


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo; what decides training and held-out rows."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor, F.lit(0))


@query
def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return language_model.score_texts(
        docs, remainder(7) == 2, tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = minhash.edited_pairs(table(spark, folder, "documents").select("doc_id", "text"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        minhash.as_text(F.col("fingerprint")).alias("fingerprint"),
        minhash.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the labelled documents that are not held out."""
    return toxicity.train(docs.filter(remainder(3) != 1), labels.select("doc_id", F.col("toxic").alias("label")))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


#: The rules of the query: verdict, host and path.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


@query
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


#: More pieces than `pack` keeps by itself, as its workers hold nothing else here.
WORKER_PIECES = 600_000


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), keep=WORKER_PIECES)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_length",
    )


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, folder, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("hit_items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter(F.transform(base, lambda s: s["kind"]), lambda found: found == kind)).cast("long")
        .alias(f"n_{kind}")
        for kind in pii.KINDS[:4]
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = lines.drop_common_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_files.read_documents(spark, token_files.write(docs, tokenizer_path("word_bpe_49k.json")))


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.find_collocations(table(spark, folder, "documents").select("text", "lang"))
