"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every run of ``width`` consecutive words of a benchmark item is a window; an item
of fewer words, but not none, is one window. The windows are broadcast by hash in
slices of at most ``max_windows``; one pass over the documents looks up each of
their word windows, verifies the hits word by word and marks the covered words.
With more slices the passes follow each other, each written to the shared folder.

Defined cases: a null or wordless text has no words and no hits; null and
wordless items have no windows; repeated item rows count once, as do repeated
item ids; items with a null id have windows like all others, but are in no list of ids; documents' ids are passed through, null and
repeated ones too; empty tables give no windows or no rows; a text of any length is read whole, in
one piece; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import words as W
from larder.llm.scratch import Scratch

WIDTH = 10
MAX_WINDOWS = 200_000       # windows broadcast at once: about 60 MB of Python objects
SEPARATORS = W.separator_table(W.NON_ALNUM)

HITS = "array<struct<begin:int,end:int,first_char:int,last_char:int>>"


def _windows(texts: pa.Array, width: int):
    """(item position, number of words, words joined by a space) of each window."""
    data, offs, _ = W.text_buffers(texts)
    for lo, hi in W.pieces(offs):
        w = W.split_words(data, offs[lo:hi + 1], SEPARATORS, True)
        for k in range(hi - lo):
            a, b = int(w.first[k]), int(w.first[k + 1])
            names = [W.FOLD[data[s:e]].tobytes() for s, e in zip(w.start[a:b], w.end[a:b])]
            size = min(width, len(names))
            for i in range(len(names) - size + 1 if size else 0):
                yield lo + k, size, b" ".join(names[i:i + size])


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Distinct (window, n_words, items) of a benchmark; items is the sorted list of ids, as strings (null ids are left out)."""

    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [(ids[k], size, window) for k, size, window in _windows(batch.column(1), width)]
            yield pa.record_batch([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.binary())], names=["item", "n_words", "window"])

    rows = items.select(F.col(item_id).cast("string"), F.col(text)).where(F.col(text).isNotNull())
    return rows.mapInArrow(cut, "item string, n_words int, window binary").groupBy("n_words", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Index:
    """Hash set of windows by their number of words."""

    def __init__(self, rows):
        by_size: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for r in rows:
            window = bytes(r["window"])
            data = np.frombuffer(window, dtype=np.uint8)
            w = W.split_words(data, np.array([0, len(data)]), SEPARATORS, False)
            code = int(W.sequence_codes(w.code, np.array([0]), r["n_words"])[0])
            by_size[r["n_words"]][code].append((window, tuple(r["items"])))
        self.sizes = {n: (np.sort(np.fromiter(codes, dtype=np.uint64, count=len(codes))), dict(codes)) for n, codes in by_size.items()}
        self.masks = {}
        for n, (codes, _) in self.sizes.items():
            self.masks[n] = np.zeros(1 << 20, dtype=bool)
            self.masks[n][codes >> np.uint64(44)] = True

    def hits(self, w: W.Words):
        """(first word, number of words, items) of every verified occurrence."""
        room = w.room()
        for n, (codes, windows) in self.sizes.items():
            at = np.flatnonzero(room >= n)
            if not len(at):
                continue
            got = W.sequence_codes(w.code, at, n)
            likely = np.flatnonzero(self.masks[n][got >> np.uint64(44)])
            place = np.searchsorted(codes, got[likely]).clip(max=len(codes) - 1)
            for k in likely[codes[place] == got[likely]]:
                i = int(at[k])
                seen = b" ".join(W.FOLD[w.data[s:e]].tobytes() for s, e in zip(w.start[i:i + n], w.end[i:i + n]))
                for window, items in windows[int(got[k])]:
                    if window == seen:
                        yield i, n, items


def _mark(docs: DataFrame, rows: list, text: str) -> DataFrame:
    """Adds to n_words, hits (spans of words and characters) and items what one slice of windows finds."""
    index = docs.sparkSession.sparkContext.broadcast(_Index(rows))
    names = docs.columns
    at_text, at_hits, at_items = names.index(text), names.index("__hits"), names.index("__items")
    schema = T.StructType([f for f in docs.schema])

    def scan(batches):
        found = index.value
        for batch in batches:
            data, offs, _ = W.text_buffers(batch.column(at_text))
            n_words = np.zeros(len(batch), dtype=np.int64)
            hits, items = batch.column(at_hits).to_pylist(), batch.column(at_items).to_pylist()
            for lo, hi in W.pieces(offs):
                w = W.split_words(data, offs[lo:hi + 1], SEPARATORS, True)
                n_words[lo:hi] = np.diff(w.first)
                of = w.text_of()
                spans = defaultdict(list)
                for i, n, who in found.hits(w):
                    row = lo + int(of[i])
                    spans[row].append((i, i + n))
                    items[row] = [*(items[row] or []), *who]
                for row, own in spans.items():
                    base, begin = int(w.first[row - lo]), int(offs[row])
                    old = [(h["begin"] + base, h["end"] + base) for h in hits[row] or []]
                    hits[row] = [{"begin": a - base, "end": b - base, **_chars(w, begin, a, b)} for a, b in _merge([*old, *own])]
                    items[row] = sorted(set(items[row]))
            columns = list(batch.columns)
            columns[names.index("__n_words")] = pa.array(n_words, pa.int64())
            columns[at_hits] = pa.array(hits, batch.schema.field(at_hits).type)
            columns[at_items] = pa.array(items, batch.schema.field(at_items).type)
            yield pa.record_batch(columns, names=names)

    return docs.mapInArrow(scan, schema)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _chars(w: W.Words, begin: int, a: int, b: int) -> dict:
    """Code points from the text's start to the span's start and end."""
    lead = w.data[begin:int(w.end[b - 1])]
    whole = (lead & 0xC0) != 0x80
    first = int(np.count_nonzero(whole[:int(w.start[a]) - begin]))
    return {"first_char": first, "last_char": int(np.count_nonzero(whole))}


def find(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
         width: int = WIDTH, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with __n_words, __hits (merged spans, end exclusive) and __items (ids, sorted strings)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    windows = scratch.write(item_windows(items, item_id, "text", width))
    total, per_item = windows.agg(F.count("*"), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
    slices = max(1, -(-max(total, per_item) // max_windows))
    out = docs.withColumns({"__n_words": F.lit(0).cast("long"), "__hits": F.lit(None).cast(HITS), "__items": F.lit(None).cast("array<string>")})
    for k in range(slices):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(slices)) == k).collect()
        out = _mark(out, rows, text)
        if k + 1 < slices:
            out = scratch.write(out)
    return out


def remove_spans(text: str, hits: str):
    """The text without its hits, each cut with its surroundings left as they are."""
    pieces = F.transform(F.sequence(F.lit(0), F.size(hits)), lambda k: F.substring(
        F.col(text),
        F.when(k == 0, F.lit(0)).otherwise(F.get(F.col(hits), k - 1)["last_char"]) + 1,
        F.when(k == F.size(hits), F.char_length(F.col(text))).otherwise(F.get(F.col(hits), k)["first_char"])
        - F.when(k == 0, F.lit(0)).otherwise(F.get(F.col(hits), k - 1)["last_char"])))
    return F.when(F.col(hits).isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate(F.coalesce("__hits", F.array().cast(HITS)), F.lit(0).cast("long"), lambda total, h: total + h["end"] - h["begin"])
    items = F.coalesce("__items", F.array().cast("array<string>"))
    return marked.select(
        "doc_id", F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE = r"""
WITH it AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM it WHERE len(w) > 0)),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN win USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
who AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN who USING (doc_id)
"""
