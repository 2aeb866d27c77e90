"""A corpus from raw documents to mixed training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
one's rows as Parquet to the shared folder and hands them on. All stages but the
last return the columns of ``documents``. The stages hold for null values in any
column, empty and very long texts, repeated rows, an empty table and extra columns, as their
operators' docstrings define; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, jaccard_join, language_id, mixing, secrets
from larder.llm.scratch import Scratch, row_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WIDTH, PERCENT = 5, 80               # near duplicates: five words, a similarity of 0.8 or more
MOSTLY = 0.5                         # documents of which this share or more is benchmark text go
#: Target tokens, as multiples of those there are. A target of no toxic tokens at all would also take
#: documents with little evidence: at sf0.1 it dropped 5.9 % of those labelled clean, this one 0.5 %.
WEIGHTS = {"toxic": 0.1, "low": 1.0, "high": 1.5}

#: SQL can express neither the classifiers nor the components; tests compare with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; a missing lang is filled in. Those without a letter go."""
    docs = docs.select(COLUMNS)
    found = language_id.predict(docs, language_id.train(docs), score_col="__score", label_col="__lang")
    return found.where(F.col("__lang") != language_id.UNKNOWN).withColumn("lang", F.coalesce("lang", "__lang")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates; rows with a null id stay, and
    rows that share an id but not a text are judged each for itself."""
    docs = docs.select(COLUMNS)
    found = jaccard_join.join(docs, width=WIDTH, percent=PERCENT, apart=True)
    first = found.where("component_id IS NOT NULL").groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("x")).select("x.*")
    stay = first.unionByName(found.where("component_id IS NULL").select("doc_id", "key").distinct())
    stay = stay.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    rows = docs.withColumn("__key", row_key("doc_id", "text")).join(stay, "__key").where(F.col("doc_id").eqNullSafe(F.col("__id")))
    return rows.dropDuplicates(["__key", "doc_id"]).select(COLUMNS)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out of the texts; documents that are mostly benchmark text go."""
    found = decontaminate.find(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate(F.coalesce("__hits", F.array().cast(decontaminate.HITS)), F.lit(0), lambda n, h: n + h["end"] - h["begin"])
    kept = found.where((hit == 0) | (hit < MOSTLY * F.col("__n_words"))).withColumn("__clean", decontaminate.remove_spans("text", "__hits"))
    size = F.when(F.col("__hits").isNull(), F.col("n_chars")).otherwise(F.char_length("__clean").cast("long"))
    return kept.select("doc_id", F.col("__clean").alias("text"), "lang", "source", size.alias("n_chars"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts replaced by a mark."""
    docs = docs.select(COLUMNS)
    ledger = Scratch(spark, "ledger").write(secrets.scan(docs, rules=secrets.REDACTED))
    found = secrets.findings(docs, ledger, COLUMNS)
    text = secrets.redact(F.col("text"), F.col("spans"))
    size = F.when(F.size("spans") == 0, F.col("n_chars")).otherwise(F.char_length("__text").cast("long"))
    return found.withColumn("__text", text).select("doc_id", F.col("__text").alias("text"), "lang", "source", size.alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their domain posteriors, rate and number of copies. Those with a rate
    below one half go, others are taken once at least; the part of a rate over whole copies is drawn by a hash of the id."""
    docs = docs.select(COLUMNS).withColumn("__key", row_key("doc_id", "text"))
    labelled = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rates = mixing.mix(docs, labelled, WEIGHTS, relative=True)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("copy")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rates = rates.withColumn("n_copies", F.when(F.col("rate") >= 0.5, F.greatest(F.lit(1), F.floor(F.col("rate") + draw))).otherwise(0).cast("int"))
    rates = rates.where("n_copies > 0").dropDuplicates(["__key"]).select("__key", "n_tokens", *[f"p_{d}" for d in WEIGHTS], "rate", "n_copies")
    return docs.join(rates, "__key").drop("__key")


STAGES = [
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("decontaminate", without_benchmarks),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage but the last is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        done = stage(spark, docs, sf_dir)
        docs = scratch.write(done)
    return STAGES[-1][1](spark, docs, sf_dir)
