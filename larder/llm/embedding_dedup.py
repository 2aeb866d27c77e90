"""Embedding near-dedup: cross-polytope hashing with multiprobe buckets.

A hash rotates a vector by three rounds of random signs and a fast Hadamard
transform and takes the coordinate that is furthest from zero, with its sign. A
bucket joins ``hashes`` of them, and there are ``tables`` tables; ``hashes`` grows
with the logarithm of the number of vectors, so buckets keep their size. Every vector lies in its own bucket of each table and also probes the
``probes`` buckets that differ in the least certain coordinate. Pairs that meet in
a bucket are verified by cosine in double precision. The hashes find most, not all
pairs: longer hashes and vectors get more tables, so that a pair at the threshold is expected
to meet with a probability of at least ``RECALL`` (``tables_for``, from the rate at which random pairs
meet in one table) at every table size; no pair below the threshold is linked.

Equal vectors are collapsed first. A large bucket is cut into blocks; tasks
compare two blocks, of at most about ``BLOCK`` vectors each, and return per vector
its number of new links and a spanning forest, never the pairs. A pair that meets
several times counts where it meets first, which both vectors' codes tell.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do vectors of different lengths; equal rows are
linked copies, also those that share an id; a row with a null id links with nothing, its
component is null and it is not kept; other columns (labels) are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.components import components
from larder.llm.scratch import Scratch

THRESHOLD = 0.9
TABLES, PROBES = 6, 4        # tables: at least
RECALL = 0.99                # expected share of the pairs at the threshold that meet
SAMPLE = 1000                # random pairs, in each of TABLES tables, from which the number of tables follows
BLOCK = 1024                 # vectors of a block
SHARD = 4096                 # rows of one group of blocks, about
PAIRS = 1 << 17              # verified pairs looked at together



def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def codes(vectors: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """(vectors, tables, 1 + probes) bucket numbers; the first is a vector's own. Missing probes are -1."""
    n, dim = vectors.shape
    d = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = vectors
    out = np.full((n, tables, 1 + probes), -1, dtype=np.int64)
    at = np.arange(n)
    for t in range(tables):
        own, other, gap = [], [], []
        for h in range(hashes):
            x = padded
            signs = np.random.default_rng([dim, t, h]).choice([-1.0, 1.0], (3, d))
            for s in signs:
                x = _hadamard(x * s) / math.sqrt(d)
            size = np.abs(x)
            order = np.argsort(-size, axis=1)[:, :1 + probes]
            symbol = np.take_along_axis(np.where(x < 0, np.arange(d) + d, np.arange(d)), order, axis=1)
            size = np.take_along_axis(size, order, axis=1)
            own.append(symbol[:, 0])
            other.append(symbol[:, 1:])
            gap.append(size[:, :1] - size[:, 1:])
        scale = [(2 * d) ** h for h in range(hashes)]
        out[:, t, 0] = sum(s * c for s, c in zip(scale, own))
        moved = np.concatenate([out[:, t, :1] + s * (o - c[:, None]) for s, c, o in zip(scale, own, other)], axis=1)
        likely = np.argsort(np.concatenate(gap, axis=1), axis=1)[:, :probes]
        out[:, t, 1:1 + likely.shape[1]] = np.take_along_axis(moved, likely, axis=1)
    return out


def tables_for(dim: int, hashes: int, probes: int, threshold: float, least: int = TABLES, recall: float = RECALL) -> int:
    """Tables in which a pair at the threshold meets with a probability of ``recall``, three standard errors of the rate left as a margin."""
    if dim < 2:
        return least
    rng = np.random.default_rng([dim, hashes])
    x, z = (rng.normal(size=(SAMPLE, dim)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold ** 2)) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = (codes(v, TABLES, hashes, probes) for v in (x, y))
    met = (a[:, :, 0] == b[:, :, 0]) | (b[:, :, 1:] == a[:, :, :1]).any(axis=2) | (a[:, :, 1:] == b[:, :, :1]).any(axis=2)
    rate = met.mean()
    rate -= 3 * math.sqrt(rate * (1 - rate) / met.size)
    if rate <= 0:
        raise ValueError(f"pairs at a cosine of {threshold} are too rare in a bucket of {hashes} hashes to reach a recall of {recall}")
    return max(least, math.ceil(math.log(1 - recall) / math.log(1 - min(rate, 1 - 1e-9))))


def _unit(vec: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are scaled by their largest component first, so that no square leaves the range of doubles."""
    vec = vec / np.abs(vec).max(axis=1, keepdims=True)
    return vec / np.linalg.norm(vec, axis=1, keepdims=True)


def _coded(rows: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """(id, dim, vec, fa, fb, codes) of the vectors that can link; vec keeps the precision it came in."""
    kind = rows.schema["vec"].dataType.elementType.simpleString()
    kind, held = ("float", np.float32) if kind == "float" else ("double", np.float64)
    schema = f"id long, dim int, vec array<{kind}>, fa long, fb long, codes array<long>"

    def code(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            bound, flat = lists.offsets.to_numpy(), lists.values
            value = np.asarray(flat.fill_null(float("nan")).to_numpy(zero_copy_only=False), dtype=np.float64)
            dims = np.diff(bound)
            for dim in np.unique(dims):
                if dim == 0:
                    continue
                at = np.flatnonzero(dims == dim)
                vec = value[bound[at][:, None] + np.arange(dim)]
                largest = np.abs(vec).max(axis=1)            # NaN and infinity come through
                good = np.isfinite(largest) & (largest > 0)
                at, vec = at[good], np.ascontiguousarray(vec[good]) + 0.0
                for lo in range(0, len(at), 2048):
                    own = vec[lo:lo + 2048]
                    made = codes(_unit(own), tables, hashes, probes)
                    bits = own.view(np.uint64)
                    prints = [(bits * np.random.default_rng([dim, k]).integers(1, 1 << 63, dim, dtype=np.uint64)).sum(axis=1) + (bits >> np.uint64(32)).sum(axis=1) * np.uint64(0x9E3779B97F4A7C15 + 2 * k) for k in (0, 1)]
                    n, width = len(own), tables * (1 + probes)
                    yield pa.record_batch([
                        ids.take(pa.array(at[lo:lo + 2048])), pa.array(np.full(n, dim, np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim, dtype=np.int32)), pa.array(own.astype(held).ravel())),
                        pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(made.ravel()))], names=["id", "dim", "vec", "fa", "fb", "codes"])

    return rows.where("id IS NOT NULL AND vec IS NOT NULL").select("id", "vec").mapInArrow(code, schema)


def _first_meeting(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of the first meeting of each pair: 3 * table + (0: same bucket, 1: y probes x's, 2: x probes y's)."""
    met = np.stack([x[:, :, 0] == y[:, :, 0], (y[:, :, 1:] == x[:, :, :1]).any(axis=2), (x[:, :, 1:] == y[:, :, :1]).any(axis=2)], axis=2)
    return met.reshape(len(x), -1).argmax(axis=1)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number in each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(table: pa.Table, tables: int, probes: int, threshold: float) -> pa.Table:
    """Links among the blocks of one shard: id, links, root."""
    table = table.combine_chunks()
    ids = table["id"].to_numpy()
    dims = table["dim"].to_numpy()
    flat, starts = table["vec"].combine_chunks().values.to_numpy().astype(np.float64), table["vec"].combine_chunks().offsets.to_numpy()
    code = table["codes"].combine_chunks().flatten().to_numpy().reshape(len(ids), tables, 1 + probes)
    size, side, of_table = table["size"].to_numpy(), table["side"].to_numpy(), table["t"].to_numpy()
    bucket, left, right = table["bucket"].to_numpy(), table["o"].to_numpy(), table["a"].to_numpy()
    order = np.lexsort((side, right, left, bucket, of_table, dims))
    change = np.zeros(len(order), dtype=bool)
    change[0] = True
    for c in (dims, of_table, bucket, left, right):
        change[1:] |= c[order][1:] != c[order][:-1]
    edges = np.append(np.flatnonzero(change), len(order))
    unique, node = np.unique(ids, return_inverse=True)
    links, pairs = np.zeros(len(unique), dtype=np.int64), []
    for lo, hi in zip(edges[:-1], edges[1:]):
        rows = order[lo:hi]
        x, y = rows[side[rows] == 0], rows[side[rows] > 0]
        if not len(x) or not len(y):
            continue
        dim, t = int(dims[x[0]]), int(of_table[x[0]])
        vx, vy = (flat[starts[r][:, None] + np.arange(dim)] for r in (x, y))
        vx, vy = _unit(vx), _unit(vy)
        i, j = np.nonzero(vx @ vy.T >= threshold)
        i, j = x[i], y[j]
        own = side[j] == 1
        fits = np.where(own, ids[i] < ids[j], ids[i] != ids[j])
        i, j, own = i[fits], j[fits], own[fits]
        for k in range(0, len(i), PAIRS):
            p, q, same = i[k:k + PAIRS], j[k:k + PAIRS], own[k:k + PAIRS]
            small, large = np.where(ids[p] < ids[q], p, q), np.where(ids[p] < ids[q], q, p)
            now = 3 * t + np.where(same, 0, np.where(small == p, 1, 2))
            counts = _first_meeting(code[small], code[large]) == now
            p, q = p[counts], q[counts]
            np.add.at(links, node[p], size[q])
            np.add.at(links, node[q], size[p])
            pairs.append((node[p], node[q]))
    a, b = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.empty(0, np.int64), np.empty(0, np.int64))
    root = _forest(len(unique), a, b)
    some = links > 0
    return pa.table({"id": unique[some], "links": links[some], "root": unique[root[some]]})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    tables: int | None = None, probes: int = PROBES) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row; ``tables`` follows from ``tables_for`` where it is not given."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vec"))
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    symbols = 2 << max(1, (max(width, 1) - 1).bit_length())
    hashes = max(1, round(math.log(max(count, 1) / 16 + 1) / math.log(symbols)))
    if tables is None:
        # the longest of the lengths that are padded to one power of two stands for them
        lengths = rows.where(F.size("vec") > 1).groupBy(F.ceil(F.log2(F.size("vec")))).agg(F.max(F.size("vec")).alias("dim")).collect()
        tables = max([TABLES, *(tables_for(r["dim"], hashes, probes, threshold) for r in lengths)])
    coded = scratch.write(_coded(rows, tables, hashes, probes))
    classes = scratch.write(coded.groupBy("dim", "fa", "fb").agg(F.min("id").alias("rep"), F.count("*").alias("size")))
    # one row per class; the vectors of a class are equal, so any of the rows with its smallest id will do
    reps = coded.join(classes, ["dim", "fa", "fb"]).where("id = rep").dropDuplicates(["dim", "fa", "fb"]).select("id", "dim", "vec", "codes", "size")
    reps = scratch.write(reps)
    places = reps.select("id", "dim", F.posexplode(F.expr(f"transform(sequence(0, {tables - 1}), t -> slice(codes, t * {1 + probes} + 1, {1 + probes}))")).alias("t", "places"))
    places = places.select("id", "dim", "t", F.posexplode("places").alias("probe", "bucket")).where("bucket >= 0").withColumn("own", F.col("probe") == 0)
    crowds = places.groupBy("dim", "t", "bucket").agg(F.count_if("own").alias("n_own"), F.count("*").alias("n_all")).where("n_own > 0 AND n_all > 1")
    crowds = crowds.withColumns({"b_own": F.ceil(F.col("n_own") / BLOCK), "b_all": F.ceil(F.col("n_all") / BLOCK)})
    places = places.join(crowds, ["dim", "t", "bucket"])
    mine = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    lefts = places.where("own").select("id", "dim", "t", "bucket", F.lit(0).alias("side"), mine("b_own", 1).alias("o"), F.explode(upto("b_all")).alias("a"))
    rights = places.select("id", "dim", "t", "bucket", F.when(F.col("own"), 1).otherwise(2).alias("side"), mine("b_all", 2).alias("a"), F.explode(upto("b_own")).alias("o"))
    blocks = scratch.write(lefts.unionByName(rights))
    shards = max(1, blocks.count() // SHARD)
    full = blocks.join(reps.select("id", "dim", "vec", "codes", "size"), ["id", "dim"])
    full = full.withColumn("shard", F.pmod(F.xxhash64("dim", "t", "bucket", "o", "a"), F.lit(shards)))
    found = scratch.write(full.groupBy("shard").applyInArrow(lambda table: _compare(table, tables, probes, threshold), "id long, links long, root long"))
    roots = components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct(), scratch)
    links = found.groupBy("id").agg(F.sum("links").alias("links")).select(F.col("id").alias("rep"), "links")
    classes = classes.join(links, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    told = coded.select("id", "dim", "fa", "fb").join(classes, ["dim", "fa", "fb"]).select(
        F.col("id").alias("i"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    # rows that share an id carry one vector each: they stand for that id together
    told = told.groupBy("i").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("id").join(told, F.col("id") == F.col("i"), "left")
    component = F.coalesce("component_id", "id")
    return scratch.finish(out.select(F.col("id").cast(vectors.schema[id_col].dataType).alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.cast(vectors.schema[id_col].dataType).alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept")))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
