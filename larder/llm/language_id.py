"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 2- and 3-grams of lower-cased letters (anything else
counts as a space) of labelled rows, per label, on the executors; only the
(labels x buckets) counts come back. Scoring broadcasts the log-probability
matrix and adds up its rows in numpy, over whole texts in bounded chunks.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
and so is every text when nothing was learned; rows with a null label or text
teach nothing; a null id counts as held out; repeated rows are scored alike; ties
between labels go to the first in order; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.scratch import crc_mod

UNKNOWN = "und"
BUCKET_BITS = 16            # hashed n-grams: 2**16 columns
ALPHA = 0.5                 # added to every count
DRAWS = 1 << 48              # steps of the share that is drawn
ROWS_PER_LABEL = 20_000     # labelled rows that one label teaches with, about; a bounded sample
MAX_LABELS = 200            # bounds the broadcast matrix: 200 x 2**16 floats are 52 MB
CHUNK_CHARS = 1 << 17


@dataclass
class LanguageModel:
    labels: list[str]
    log_prob: np.ndarray    # buckets x labels
    log_prior: np.ndarray

    @property
    def empty(self) -> bool:
        return not self.labels


_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def _units(texts: list[str | None]):
    """Joins chunks of lower-cased texts, each behind the two characters before it
    (NULs at a text's start), up to a bounded size: (string, rows, lengths)."""
    joined, rows, lengths, size = [], [], [], 0
    for row, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, len(text), CHUNK_CHARS):
            part = text[at:at + CHUNK_CHARS]
            joined.append((text[at - 2:at] if at else "\0\0") + part)
            rows.append(row)
            lengths.append(len(part))
            size += len(part)
            if size >= CHUNK_CHARS:
                yield "".join(joined), rows, lengths
                joined, rows, lengths, size = [], [], [], 0
    if rows:
        yield "".join(joined), rows, lengths


def _grams(joined: str, lengths: list[int]):
    """Buckets of the n-grams that end at each character: array (2, characters); letter flags."""
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    c = np.where(letter | (codes == 0), codes, 32).astype(np.uint32)
    size = np.asarray(lengths)
    begin = np.concatenate([[0], np.cumsum(size + 2)[:-1]])
    at = np.arange(int(size.sum())) + np.repeat(2 * np.arange(1, len(size) + 1), size)
    two = c[at] * np.uint32(0x85EBCA6B) + c[at - 1] * np.uint32(0xC2B2AE35)
    three = two + c[at - 2] * np.uint32(0x27D4EB2F) + np.uint32(0x165667B1)
    shift = np.uint32(32 - BUCKET_BITS)
    spread = [(x ^ (x >> np.uint32(15))) * np.uint32(0x9E3779B1) >> shift for x in (two, three)]
    return np.stack(spread), letter[at], begin


def train(docs: DataFrame, text: str = "text", label: str = "lang",
          rows_per_label: int = ROWS_PER_LABEL, id_col: str = "doc_id") -> LanguageModel:
    """Fit on rows with text and label; about ``rows_per_label`` of each label, by a hash of id and text: copies
    of a text are drawn each for itself (rows equal in both together)."""
    draw = F.pmod(F.xxhash64(*[F.col(c) for c in (id_col, text) if c in docs.columns]), F.lit(DRAWS))
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"), draw.alias("draw")).where("text IS NOT NULL AND label IS NOT NULL")
    sizes = rows.groupBy("label").count().orderBy("label").limit(MAX_LABELS + 1).collect()
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels in column {label!r}")
    labels = [r["label"] for r in sizes]
    if not labels:
        return LanguageModel([], np.zeros((0, 0)), np.zeros(0))
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("label") == r["label"], F.lit(int(DRAWS * min(1.0, rows_per_label / r["count"])))).otherwise(share)
    sample = rows.where(F.col("draw") < share).select("text", "label")
    index = {name: k for k, name in enumerate(labels)}
    buckets = 1 << BUCKET_BITS

    def count(batches):
        total = np.zeros((len(labels), buckets), dtype=np.int64)
        for batch in batches:
            kinds = [index[x] for x in batch.column(1).to_pylist()]
            for joined, of, lengths in _units(batch.column(0).to_pylist()):
                grams, _, _ = _grams(joined, lengths)
                kind = np.repeat(np.asarray([kinds[r] for r in of]), lengths)
                for row in grams:
                    total += np.bincount(kind * buckets + row, minlength=total.size).reshape(total.shape)
        kind, bucket = np.nonzero(total)
        yield pa.record_batch([pa.array(kind * buckets + bucket, pa.int64()), pa.array(total[kind, bucket], pa.int64())], names=["cell", "n"])

    cells = sample.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(labels) * buckets)
    counts[cells["cell"].to_numpy(dtype=np.int64)] = cells["n"].to_numpy(dtype=float)
    counts = counts.reshape(len(labels), buckets).T + ALPHA
    prior = np.asarray([r["count"] for r in sizes], dtype=float)
    return LanguageModel(labels, np.log(counts / counts.sum(axis=0)).astype(np.float32), np.log(prior / prior.sum()))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text",
            label_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` with the predicted label and its posterior; replaces columns of those names."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in (label_col, score_col)]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(label_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)
    where = kept.index(text)

    def score(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(where).to_pylist()
            total = np.zeros((len(texts), max(1, len(model.labels))))
            lettered = np.zeros(len(texts), dtype=bool)
            for joined, rows, lengths in _units(texts):
                grams, letter, _ = _grams(joined, lengths)
                first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                of = np.asarray(rows)
                np.logical_or.at(lettered, of, np.logical_or.reduceat(letter, first))
                if not model.empty:
                    for row in grams:
                        np.add.at(total, of, np.add.reduceat(model.log_prob[row], first, axis=0, dtype=np.float64))
            if model.empty:
                lettered[:] = False
                best, sure = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
            else:
                total += model.log_prior
                best = total.argmax(axis=1)
                sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            yield pa.record_batch([*batch.columns, pa.array(names, pa.string()), pa.array(np.where(lettered, sure, 0.0), pa.float64())], names=schema.names)

    return docs.select(*kept).mapInArrow(score, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = (crc_mod("doc_id", 5) == 0).alias("held_out")
    model = train(docs.where(crc_mod("doc_id", 5) != 0))
    return predict(docs.select("doc_id", held_out, "text"), model).drop("text")
