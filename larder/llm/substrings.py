"""Substring dedup by seed and extend: repeated runs of ``length`` words, removed.

Seeds: of the hashes of ``SEED`` consecutive words in every window the smallest
(the leftmost of equals) is the window's anchor. Windows with equal words have the same
anchor at the same place, so equal windows meet at an anchor. Anchors seen once
drop out (a join on their counts); no pairs are made.

Extension: an anchor is extended left and right over the whole run of windows
that chose it. Runs that another occurrence shares word for word are repeats
(a count per run). Where one anchor has several runs, the runs are compared
window by window: one representative of each run reads its text again, and
windows that two runs share are repeats. Overlapping repeats merge into maximal spans.

Two independent 64-bit hashes (anchor and run, or anchor and window) must agree, so
unequal windows are taken for equal with a chance of about 2**-110 a pair.

Groups of copies only meet in counts, which are summed before the shuffle; the
joins back to the occurrences can be split by Spark where an anchor is very common.

Defined cases: null and wordless texts have no words, nothing removed, and an
empty text kept; a text shorter than ``length`` words stays; rows equal in id and
text are copies of each other; null ids are passed through; an empty table gives no rows; a text of any
length is read whole, by one task; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import words as W
from larder.llm.scratch import Scratch, row_key

LENGTH = 35
SEED = 8
WINDOWS = 1 << 17            # windows handed on together
SEPARATORS = W.separator_table(W.SPACE)


def _anchors(w: W.Words, length: int):
    """(anchor word, anchor hash, first window, number of windows) per anchor, all in piece positions."""
    reach = length - SEED + 1                      # seeds in a window
    n = len(w.start) - length + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, np.empty(0, dtype=np.uint64), none, none
    seeds = W.sequence_codes(w.code, np.arange(len(w.start) - SEED + 1), SEED)
    least, at = seeds.copy(), np.arange(len(seeds))
    width = 1
    while width < reach:                           # leftmost minimum of `width` seeds, doubled
        step = min(width, reach - width)
        other, there = least[step:], at[step:]
        size = len(other)
        lower = other < least[:size]
        least, at = np.where(lower, other, least[:size]), np.where(lower, there, at[:size])
        width += step
    window = np.flatnonzero(w.room()[:n] >= length)
    anchor = at[window]
    if not len(window):
        return window, np.empty(0, dtype=np.uint64), window, window
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(window) != 1)]))
    return anchor[first], seeds[anchor[first]], window[first], np.diff(np.append(first, len(window)))


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), row_key(id_col, text).alias("key"))


def occurrences(keyed: DataFrame, length: int) -> DataFrame:
    """(anchor, run, id, key, lo, n): n windows from word lo on share the anchor; run hashes their words."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("run", T.LongType()), keyed.schema["id"],
                           T.StructField("key", T.LongType()), T.StructField("lo", T.IntegerType()), T.StructField("n", T.IntegerType())])

    def seed(batches):
        for batch in batches:
            data, offs, _ = W.text_buffers(batch.column(1))
            for lo, hi in W.pieces(offs):
                w = W.split_words(data, offs[lo:hi + 1], SEPARATORS, False)
                at, code, first, n = _anchors(w, length)
                of = w.text_of()[first]
                run = W.sequence_codes(w.code, first, n + length - 1, True) ^ W.mix((at - first).astype(np.uint64))
                rows = pa.array(of + lo, pa.int64())
                yield pa.record_batch([pa.array(W.signed(code)), pa.array(W.signed(run)), batch.column(0).take(rows), batch.column(2).take(rows),
                                       pa.array((first - w.first[of]).astype(np.int32)), pa.array(n.astype(np.int32))], names=schema.names)

    return keyed.select("id", "text", "key").mapInArrow(seed, schema)


def _window_rows(texts: DataFrame, length: int) -> DataFrame:
    """(window, anchor, run, at): hashes of the windows of the runs listed with each text."""

    def extend(batches):
        for batch in batches:
            data, offs, _ = W.text_buffers(batch.column(1))
            bound = batch.column(3).offsets.to_numpy()
            listed = batch.column(3).flatten()
            anchor, run, begin, count = (listed.field(c).to_numpy() for c in ("anchor", "run", "lo", "n"))
            row, bound = np.repeat(np.arange(len(batch)), np.diff(bound)), bound - bound[0]
            for lo, hi in W.pieces(offs):
                w = W.split_words(data, offs[lo:hi + 1], SEPARATORS, False)
                at = bound[lo]
                while at < bound[hi]:                  # runs of about WINDOWS windows together
                    to = max(at + 1, int(np.searchsorted(np.cumsum(count[at:bound[hi]]), WINDOWS, side="right")) + at)
                    n = count[at:to].astype(np.int64)
                    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    code = W.sequence_codes(w.code, np.repeat(w.first[row[at:to] - lo] + begin[at:to], n) + place, length, True)
                    yield pa.record_batch([pa.array(W.signed(code)), pa.array(np.repeat(anchor[at:to], n)), pa.array(np.repeat(run[at:to], n)), pa.array(place.astype(np.int32))], names=["window", "anchor", "run", "at"])
                    at = to

    return texts.select("id", "text", "key", "runs").mapInArrow(extend, "window long, anchor long, run long, at int")


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, key, spans): words [begin, end) of each row that lie in a repeated window; rows without any are left out."""
    scratch = Scratch(docs.sparkSession, "substrings")
    keyed = _keyed(docs, id_col, text)
    seeds = scratch.write(occurrences(keyed, length))
    # written, so that both sides of the join are plain shuffles, which Spark splits where an anchor is very common
    common = scratch.write(seeds.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"))
    seen = scratch.write(seeds.join(common, "anchor", "left_semi"))
    scratch.drop(seeds, common)
    runs = seen.groupBy("anchor", "run").agg(F.count("*").alias("c"), F.min(F.struct("id", "key", "lo", "n")).alias("one"))
    runs = scratch.write(runs)
    # runs shared as a whole; and runs whose anchor has others: those are compared window by window
    mixed = runs.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    unsure = runs.join(mixed, "anchor", "left_semi")
    listed = unsure.groupBy("one.id", "one.key").agg(F.collect_list(F.struct("anchor", "run", "one.lo", "one.n")).alias("runs"))
    windows = scratch.write(_window_rows(_with(keyed, listed, "runs").where("runs IS NOT NULL"), length))
    shared = windows.groupBy("anchor", "window").agg(F.min("run").alias("a"), F.max("run").alias("b")).where("a != b").select("anchor", "window")
    partial = windows.join(shared, ["anchor", "window"], "left_semi").groupBy("anchor", "run").agg(F.sort_array(F.collect_set("at")).alias("at"))
    # repeated windows of a run: all, or those listed (every occurrence of the run has them)
    whole = runs.where("c > 1").select("anchor", "run", F.lit(None).cast("array<int>").alias("at"))
    hit = scratch.write(whole.unionByName(partial.join(runs.where("c > 1"), ["anchor", "run"], "left_anti")))
    spans = seen.join(hit, ["anchor", "run"]).select("id", "key", F.explode(F.when(
        F.col("at").isNull(), F.array(F.struct(F.col("lo").alias("begin"), (F.col("lo") + F.col("n") + (length - 1)).alias("end")))).otherwise(
        F.transform("at", lambda a: F.struct((F.col("lo") + a).alias("begin"), (F.col("lo") + a + length).alias("end"))))).alias("span"))
    return scratch.finish(spans.groupBy("id", "key").agg(F.sort_array(F.collect_set("span")).alias("spans")))


def _with(keyed: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """All rows of ``keyed`` with what was found for their id and key."""
    other = found.select(F.col("id").alias("id_"), F.col("key").alias("key_"), column)
    return keyed.join(other, (F.col("key") == F.col("key_")) & F.col("id").eqNullSafe(F.col("id_")), "left").select("id", "text", "key", column)


def remove(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(id_col, kept, n_words, n_removed): every row's words outside repeated windows, joined by one space."""
    keyed = _keyed(docs, id_col, text)
    marked = _with(keyed, repeats(docs, id_col, text, length), "spans")
    return _cut(marked, id_col, lambda words: words, "kept string")


def _cut(marked: DataFrame, id_col: str, finish, column: str) -> DataFrame:
    kind = T.StructType([T.StructField(id_col, marked.schema["id"].dataType), T.StructField(column.split()[0], T.StringType()),
                         T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def cut(batches):
        for batch in batches:
            data, offs, _ = W.text_buffers(batch.column(1))
            spans = batch.column(3)
            clean = ~np.asarray(spans.is_valid())
            lists = spans.fill_null([]) if spans.null_count else spans
            flat, bound = lists.flatten(), lists.offsets.to_numpy()
            begins, ends = flat.field("begin").to_numpy(), flat.field("end").to_numpy()
            bound = bound - bound[0]
            kept, n_words, n_removed = [], np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for lo, hi in W.pieces(offs):
                w = W.split_words(data, offs[lo:hi + 1], SEPARATORS, False)
                for k in range(lo, hi):
                    a, b = int(w.first[k - lo]), int(w.first[k - lo + 1])
                    stay = np.ones(b - a, dtype=bool)
                    if not clean[k]:
                        change = np.zeros(b - a + 1, dtype=np.int64)
                        np.add.at(change, begins[bound[k]:bound[k + 1]], 1)
                        np.add.at(change, ends[bound[k]:bound[k + 1]], -1)
                        stay = np.cumsum(change)[:-1] == 0
                    n_words[k], n_removed[k] = b - a, (b - a) - int(stay.sum())
                    raw = data[int(offs[k]):int(offs[k + 1])].tobytes()
                    words = raw.split()                # splits at the same six bytes
                    if n_removed[k]:
                        words = [x for x, s in zip(words, stay) if s]
                    kept.append(finish(b" ".join(words)))
            yield pa.record_batch([batch.column(0), pa.array([x.decode() if isinstance(x, bytes) else x for x in kept], pa.string()),
                                   pa.array(n_words), pa.array(n_removed)], names=kind.names)

    return marked.select("id", "text", "key", "spans").mapInArrow(cut, kind)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = _with(_keyed(docs, "doc_id", "text"), repeats(docs), "spans")
    return _cut(marked, "doc_id", lambda kept: hashlib.sha256(kept).hexdigest(), "kept_sha256 string")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT r, i, hash(array_to_string(list_slice(w, i, i + 34), ' ')) AS h, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT h, s FROM win GROUP BY h, s HAVING count(*) > 1),
cov AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win JOIN rep USING (h, s)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN cov USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
