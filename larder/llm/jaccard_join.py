"""N-gram Jaccard join: grouped prefix join with exact verification.

A document's set holds its distinct ``width``-word shingles (64-bit hashes). Two
sets can only reach the threshold if they share a shingle among their prefixes:
the rarest of their shingles in one global order, ``n - ceil(t n) + 1`` of them.
The order counts very frequent shingles last: a first pass counts shingles that
repeat nearby, and the most frequent, at most ``MAX_HEAVY``, are broadcast. Any
order gives the same links; this one only keeps common passages out of prefixes.

Documents with equal sets form a class, classes with equal prefixes and size a
group. Candidates come from groups that share a prefix shingle:
  1. In every shingle's list each group is paired with the next one by size and with
     the group that has the fewest rarer shingles, and the classes of a group in a chain. Verified
     pairs link most of a near-copy cluster, in a number of pairs linear in the rows.
  2. All pairs of classes that still lie in different components, share a prefix
     shingle and pass the size and position bounds are verified; classes of one group
     share all of it, so they are paired once a group, large groups in blocks.
Both steps verify on full sets, after a bound from the prefixes (in step 1 also from the sets'
histograms, a byte for about four shingles): first by the low halves of the
hashes, then, where a few of them could tip the scale, by whole ones. No link between components is missed: pairs not
compared already lie in one component. Verification reads only the texts of candidates.

Long lists and large groups are cut into blocks in step 2, so no task holds all pairs of one.

``links=True`` leaves step 1 out: step 2 then takes every class as a component of its own
and verifies all pairs of classes. ``n_links`` counts for each row the other
distinct (id, text) rows that reach the threshold with it, copies in equal sets included.
``class_links`` returns those pairs of classes themselves.

Defined cases: null and wordless texts have an empty set and link with nothing;
shorter texts are one shingle; rows that share an id are one document; rows with a
null id link with nothing and their component is null; an empty table gives no rows; a text of any length is one
set, which one task holds; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import words as W
from larder.llm.components import components
from larder.llm.scratch import Scratch, row_key
from larder.operators.joins import broadcast_bounded

WIDTH, PERCENT = 4, 85
MAX_HEAVY = 1 << 20          # frequent shingles broadcast: 9 MB
NEARBY = 1 << 22             # shingles among which the first pass looks for repeats
MAX_KEYS = 1 << 20           # row keys broadcast to pick candidates' rows: 8 MB
BLOCK = 1024                 # classes of a block of a large group
PER_BIN = 4                  # shingles of a histogram's bin, about; at most MOST_BINS bins
MOST_BINS = 1 << 12
SEPARATORS = W.separator_table(W.SPACE)


def _shingles(w: W.Words, width: int):
    """(text, hash) of the distinct shingles of each text, in order of text and hash."""
    counts = np.diff(w.first)
    full = np.flatnonzero(w.room() >= width)
    short = np.flatnonzero((counts > 0) & (counts < width))
    begin = np.concatenate([full, w.first[short]])
    size = np.concatenate([np.full(len(full), width), counts[short]])
    of = np.concatenate([w.text_of()[full], short])
    code = W.sequence_codes(w.code, begin, size)
    order = np.lexsort((code, of))
    of, code = of[order], code[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (code[1:] != code[:-1])
    return of[new], code[new]


def _read(batch_column, width):
    """Piece by piece: first text, texts, (text, hash) rows."""
    data, offs, _ = W.text_buffers(batch_column)
    for lo, hi in W.pieces(offs):
        yield lo, hi - lo, *_shingles(W.split_words(data, offs[lo:hi + 1], SEPARATORS, True), width)


def heavy_shingles(texts: DataFrame, width: int, most: int = MAX_HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and log2 counts of the shingles that repeat most; at most ``most``."""

    def nearby(batches):
        def repeated(codes):
            found, n = np.unique(np.concatenate(codes), return_counts=True)
            return pa.record_batch([pa.array(W.signed(found[n > 1])), pa.array(n[n > 1])], names=["code", "n"])

        held, size = [], 0
        for batch in batches:
            for _, _, _, code in _read(batch.column(0), width):
                held.append(code)
                size += len(code)
                if size >= NEARBY:
                    yield repeated(held)
                    held, size = [], 0
        if held:
            yield repeated(held)

    scratch = Scratch(texts.sparkSession, "heavy")
    counts = scratch.write(texts.mapInArrow(nearby, "code long, n long").groupBy("code").agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("level")))
    levels = {r["level"]: r["count"] for r in counts.groupBy("level").count().collect()}
    least, total = 64, 0
    for level in sorted(levels, reverse=True):
        total += levels[level]
        if total > most:
            break
        least = level
    table = counts.where(F.col("level") >= least).toArrow()
    scratch.drop(counts)
    code = table.column("code").to_numpy().view(np.uint64)
    order = np.argsort(code)
    return code[order], table.column("level").to_numpy()[order].astype(np.uint8)


def _need(n, percent):
    """Shingles of the larger of two sets that must be shared at least: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def _histograms(of: np.ndarray, code: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Each text's shingles counted by the low bits of their hashes, a byte a bin (a power of two of them, by the
    text's size); empty where a count leaves the byte."""
    bins = 1 << np.ceil(np.log2(np.clip(n / PER_BIN, 1, MOST_BINS))).astype(np.int64)
    bound = np.concatenate([[0], np.cumsum(bins)])
    counts = np.bincount(bound[of] + (code & (bins[of] - 1).astype(np.uint64)).astype(np.int64), minlength=bound[-1])
    full = np.maximum.reduceat(counts, bound[:-1]) > 255 if len(n) else np.zeros(0, dtype=bool)
    flat = counts.astype(np.uint8).tobytes()
    return [b"" if f else flat[a:b] for a, b, f in zip(bound[:-1], bound[1:], full)]


def _most_shared(x: bytes, y: bytes) -> int | None:
    """The most shingles that sets of these histograms can share: the smaller count of each bin, after the finer one
    is folded to the bins of the other. None where one is empty."""
    if not x or not y:
        return None
    a, b = sorted((np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)), key=len)
    return int(np.minimum(a, b.reshape(-1, len(a)).sum(axis=0)).sum())


def signatures(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, key, n, fa, fb, pf, prefix, bins) of (id, text, key): size, fingerprints of set and prefix, the prefix, the set's histogram."""
    heavy = rows.sparkSession.sparkContext.broadcast(heavy_shingles(rows.select("text"), width))
    schema = T.StructType([rows.schema["id"], T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("fa", T.LongType()),
                           T.StructField("fb", T.LongType()), T.StructField("pf", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("bins", T.BinaryType())])

    def sign(batches):
        known, level = heavy.value
        for batch in batches:
            for lo, count, of, code in _read(batch.column(1), width):
                n = np.bincount(of, minlength=count)
                bound = np.concatenate([[0], np.cumsum(n)])
                rank = np.zeros(len(code), dtype=np.uint8)
                if len(known):
                    place = np.searchsorted(known, code).clip(max=len(known) - 1)
                    rank = np.where(known[place] == code, level[place], 0)
                total = [np.concatenate([[np.uint64(0)], np.cumsum(W.mix(code + np.uint64(salt)))]) for salt in (0, 0x9E3779B9)]
                fa, fb = (t[bound[1:]] - t[bound[:-1]] for t in total)
                bins = _histograms(of, code, n)
                code = code[np.lexsort((code, rank, of))]
                size = np.where(n > 0, n - _need(n, percent) + 1, 0)
                ends = np.concatenate([[0], np.cumsum(size)])
                prefix = code[np.arange(ends[-1]) + np.repeat(bound[:-1] - ends[:-1], size)]
                chain = W.sequence_codes(prefix, ends[:-1], size)
                yield pa.record_batch([batch.column(0).slice(lo, count), batch.column(2).slice(lo, count), pa.array(n.astype(np.int64)), pa.array(W.signed(fa)), pa.array(W.signed(fb)),
                                       pa.array(W.signed(chain)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(W.signed(prefix))), pa.array(bins, pa.binary())], names=schema.names)

    return rows.select("id", "text", "key").mapInArrow(sign, schema)


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose key is wanted (a written table): a broadcast of at most MAX_KEYS keys, beyond that a shuffle."""
    return rows.join(broadcast_bounded(wanted, wanted.count(), MAX_KEYS), "key", "left_semi").select(*rows.columns)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"))


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("ka").alias("key")).unionByName(pairs.select(F.col("kb").alias("key"))).distinct()


def _bounded(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes and histograms leave the threshold in reach: up to the end of the prefix that
    ends first, only shared shingles count; after it at most all that remain."""
    kind = "struct<n:bigint,prefix:array<bigint>,bins:binary>"
    side = lambda k, p: prefixes.select(F.col("key").alias(k), F.struct("n", "prefix", "bins").cast(kind).alias(p))

    def reach(batches):
        for batch in batches:
            rows = [(batch.column(c).field("n").to_numpy(), batch.column(c).field("prefix"), batch.column(c).field("bins").to_pylist()) for c in (2, 3)]
            (na, pa_, ha), (nb, pb, hb) = rows
            ao, bo, av, bv = pa_.offsets.to_numpy(), pb.offsets.to_numpy(), pa_.values.to_numpy(), pb.values.to_numpy()
            good = np.zeros(len(batch), dtype=bool)
            for k in range(len(batch)):
                x, y = av[ao[k]:ao[k + 1]], bv[bo[k]:bo[k + 1]]
                both, at, there = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                if len(both):
                    most = len(both) + min(na[k] - at.max() - 1, nb[k] - there.max() - 1)
                    good[k] = (100 + percent) * most >= percent * (na[k] + nb[k])
                if good[k] and (most := _most_shared(ha[k], hb[k])) is not None:
                    good[k] = (100 + percent) * most >= percent * (na[k] + nb[k])
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["ka", "kb"]).filter(pa.array(good))

    return pairs.join(side("ka", "pa"), "ka").join(side("kb", "pb"), "kb").select("ka", "kb", "pa", "pb").mapInArrow(reach, "ka long, kb long")


def _sets(rows: DataFrame, wanted: DataFrame, width: int, short: bool) -> DataFrame:
    """(key, n, codes): the sorted set of each wanted row; ``short``: the distinct low halves of its hashes."""
    kind = "int" if short else "long"

    def emit(batches):
        for batch in batches:
            for lo, count, of, code in _read(batch.column(0), width):
                n = np.bincount(of, minlength=count)
                if short:
                    low = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    order = np.lexsort((low, of))
                    of, low = of[order], low[order]
                    new = np.ones(len(of), dtype=bool)
                    new[1:] = (of[1:] != of[:-1]) | (low[1:] != low[:-1])
                    of, held = of[new], low[new].view(np.int32)
                else:
                    held = W.signed(code)
                bound = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=count))])
                yield pa.record_batch([batch.column(1).slice(lo, count), pa.array(n.astype(np.int32)), pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(held))], names=["key", "n", "codes"])

    return _only(rows.select("text", "key"), wanted).mapInArrow(emit, f"key long, n int, codes array<{kind}>")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(ka, kb, sure) of the pairs whose sets reach the threshold. On short sets hashes may agree by chance, and those of one set
    may be equal: pairs that so few shingles could decide are not sure; on whole sets all are."""
    left = sets.select(F.col("key").alias("ka"), F.struct("n", "codes").alias("ca"))
    right = sets.select(F.col("key").alias("kb"), F.struct("n", "codes").alias("cb"))
    short = sets.schema["codes"].dataType.elementType.simpleString() == "int"

    def reach(batches):
        for batch in batches:
            (na, a), (nb, b) = ((batch.column(c).field("n").to_numpy(), batch.column(c).field("codes")) for c in (2, 3))
            ao, bo = a.offsets.to_numpy(), b.offsets.to_numpy()
            av, bv = a.values.to_numpy(), b.values.to_numpy()
            good, sure = np.zeros(len(batch), dtype=bool), np.ones(len(batch), dtype=bool)
            for k in range(len(batch)):
                x, y = av[ao[k]:ao[k + 1]], bv[bo[k]:bo[k + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                doubt = 0 if not short else 2 + -(-8 * len(x) * len(y) >> 32) + int(na[k] - len(x) + nb[k] - len(y))
                total = percent * int(na[k] + nb[k])
                good[k] = (100 + percent) * (both + doubt) >= total
                sure[k] = (100 + percent) * (both - doubt) >= total
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sure)], names=["ka", "kb", "sure"]).filter(pa.array(good))

    return pairs.join(left, "ka").join(right, "kb").select("ka", "kb", "ca", "cb").mapInArrow(reach, "ka long, kb long, sure boolean")


def _within(a, b, percent):
    """Whether two groups may count as meeting in a list: their sizes leave the threshold in reach, and
    from this shingle on each has as many as they must share. A pair that reaches the threshold
    meets so in its first common shingle; what it shares after the last such list follows that one in both."""
    return (100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])) & (
        (100 + percent) * F.least(a["n"] - a["pos"], b["n"] - b["pos"]) >= percent * (a["n"] + b["n"]))


def _inside(placed: DataFrame) -> DataFrame:
    """The (ka, kb) pairs of classes of one group that lie in different components; a large group is cut into blocks."""
    mixed = placed.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / BLOCK).alias("blocks")).where("lo != hi")
    cut = placed.join(mixed.select("gid", "blocks"), "gid").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    x = cut.select("gid", F.col("own").alias("o"), every.alias("a"), F.col("key").alias("ka"), F.col("root").alias("x"))
    y = cut.select("gid", every.alias("o"), F.col("own").alias("a"), F.col("key").alias("kb"), F.col("root").alias("y"))
    return x.join(y, ["gid", "o", "a"]).where("x < y").select("ka", "kb")


def _linked(docs: DataFrame, id_col: str, text: str, width: int, percent: int, scratch: Scratch, links: bool, apart: bool = False):
    """The rows' signatures, their classes, (key, id) of the classes and verified (ka, kb) pairs of
    them: all pairs with ``links``, else enough for the components. ``apart``: a class's id is its key."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), row_key(id_col, text).alias("key"))
    signed = scratch.write(signatures(rows, width, percent))
    named = signed.where("n > 0 AND id IS NOT NULL")
    classes = scratch.write(named.groupBy("n", "fa", "fb").agg(F.min(F.struct("id", "key")).alias("rep"), F.min("pf").alias("pf"), F.count("*").alias("copies")))
    groups = named.groupBy("n", "pf").agg(F.min("key").alias("gid"), F.first("prefix").alias("prefix"))
    members = scratch.write(classes.join(groups.select("n", "pf", "gid"), ["n", "pf"]).select("gid", "n", F.col("rep.key" if apart else "rep.id").alias("id"), F.col("rep.key").alias("key")))
    # lists of the groups that hold a prefix shingle, where there is more than one, with the next group
    # by size and the one that has the fewest rarer shingles
    here = F.struct("gid", "n", "pos")
    line = Window.partitionBy("token").orderBy("n", "gid")
    lists = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    lists = lists.select("token", "gid", "n", "pos", F.lag("gid").over(line).alias("last"), F.lead(here).over(line).alias("next"),
                         F.first(here).over(Window.partitionBy("token").orderBy("pos", "gid")).alias("hub"))
    lists = scratch.write(lists.where("last IS NOT NULL OR next IS NOT NULL").drop("last"))
    if links:
        pairs = scratch.write(members.select(F.col("key").alias("ka"), F.col("key").alias("kb")).limit(0))
        linked, placed = pairs, members.select("gid", "n", "key", F.col("key").alias("root"))
    else:
        near = lists.select(here.alias("e"), F.explode(F.array("next", "hub")).alias("o"))
        near = near.where("o IS NOT NULL AND e.gid != o.gid").where(_within(F.col("e"), F.col("o"), percent))
        near = near.select(F.least("e.gid", "o.gid").alias("gid"), F.greatest("e.gid", "o.gid").alias("other")).distinct()
        first = scratch.write(members.groupBy("gid").agg(F.min("key").alias("key")))      # written, so that Spark can split a common hub
        a, b = (first.select(F.col("gid").alias(g), F.col("key").alias(k)) for g, k in (("gid", "ka"), ("other", "kb")))
        chain = Window.partitionBy("gid").orderBy("key")
        inner = members.select(F.col("key").alias("ka"), F.lead("key").over(chain).alias("kb")).where("kb IS NOT NULL")
        pairs = scratch.write(_ordered(near.join(a, "gid").join(b, "other").select("ka", "kb").unionByName(inner)))
        scratch.drop(first)
        keys = scratch.write(_keys(pairs))
        prefixes = scratch.write(_only(signed.select("key", "n", "prefix", "bins"), keys))
        near_pairs = scratch.write(_bounded(pairs, prefixes, percent))
        scratch.drop(keys, prefixes)
        linked = _check(rows, near_pairs, width, percent, scratch)
        scratch.drop(near_pairs)
        roots = components(_as_ids(linked, members), scratch)
        placed = members.join(roots, F.col("id") == F.col("node"), "left").select("gid", "n", "key", F.coalesce("root", "id").alias("root"))
    # step 2: classes of different components in one list
    entries = lists.select("token", "gid", "pos").join(placed, "gid").select("token", "gid", F.struct("n", "pos", "key").alias("e"), "root")
    split = entries.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / BLOCK).alias("blocks")).where("lo != hi")
    # long lists are cut into blocks: a block's own entries meet those of every block
    entries = scratch.write(entries.join(split.select("token", "blocks"), "token"))
    own, every = F.pmod(F.xxhash64("e.key"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    side = lambda cuts, g, e, r: entries.select("token", *cuts, F.col("gid").alias(g), F.col("e").alias(e), F.col("root").alias(r))
    x, y = side([own.alias("left"), every.alias("right")], "gx", "e", "x"), side([every.alias("left"), own.alias("right")], "gy", "o", "y")
    met = x.join(y, ["token", "left", "right"]).where((F.col("x") < F.col("y")) & (F.col("gx") != F.col("gy")) & _within(F.col("e"), F.col("o"), percent))
    met = met.groupBy(F.col("e.key").alias("key_a"), F.col("o.key").alias("key_b"), F.col("e.n").alias("n_a"), F.col("o.n").alias("n_b")).agg(
        F.count("*").alias("shared"), F.max("e.pos").alias("pa"), F.max("o.pos").alias("pb"))
    rest = F.least(F.col("n_a") - F.col("pa") - 1, F.col("n_b") - F.col("pb") - 1)
    met = met.where((100 + percent) * (F.col("shared") + rest) >= percent * (F.col("n_a") + F.col("n_b")))
    met = met.select(F.col("key_a").alias("ka"), F.col("key_b").alias("kb")).unionByName(_inside(placed))
    # pairs that step 1 has compared in vain are not compared again
    met = scratch.write(_ordered(met).join(pairs, ["ka", "kb"], "left_anti"))
    scratch.drop(lists, entries)
    found = scratch.write(linked.unionByName(_check(rows, met, width, percent, scratch)))
    scratch.drop(met)
    return signed, classes, members.select("key", "id"), found


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, links: bool = False, apart: bool = False) -> DataFrame:
    """(id_col, key, n_shingles, component_id) of every row, and n_links with ``links``; key tells rows with one id apart.
    ``apart``: rows that share an id but not a text are documents of their own, and component_id
    is a key in the component, the same for all its rows."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    signed, classes, ids, linked = _linked(docs, id_col, text, width, percent, scratch, links, apart)
    whole = components(_as_ids(linked, ids), scratch)
    classes = classes.select("n", "fa", "fb", F.col("rep.id").alias("rep"), F.col("rep.key").alias("rep_key"))
    found = signed.select("id", "key", "n", "fa", "fb").join(classes, ["n", "fa", "fb"], "left")
    name = "rep_key" if apart else "rep"
    found = found.join(whole, F.col(name) == F.col("node"), "left")
    more = []
    if links:
        copies = _copies(signed, classes)
        both = linked.unionByName(linked.select(F.col("kb").alias("ka"), F.col("ka").alias("kb")))
        far = both.join(copies.withColumnRenamed("rep_key", "kb"), "kb").groupBy("ka").agg(F.sum("copies").alias("far"))
        near = copies.join(far, F.col("rep_key") == F.col("ka"), "left").select(F.col("rep_key").alias("of"), (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("links"))
        found = found.join(near, F.when(F.col("id").isNotNull(), F.col("rep_key")) == F.col("of"), "left")
        more = [F.coalesce("links", F.lit(0)).cast("long").alias("n_links")]
    return scratch.finish(found.select(F.col("id").alias(id_col), "key", F.col("n").alias("n_shingles"),
                                       F.when(F.col("id").isNotNull(), F.coalesce("root", name, "key" if apart else "id")).alias("component_id"), *more))


def class_links(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key_a, key_b, copies_a, copies_b) of every pair of classes that reach the threshold: the keys
    of their first rows and the distinct (id, text) rows of each."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    signed, classes, _, linked = _linked(docs, id_col, text, width, percent, scratch, True)
    copies = _copies(signed, classes.select("n", "fa", "fb", F.col("rep.key").alias("rep_key")))
    a, b = (copies.select(F.col("rep_key").alias(k), F.col("copies").alias(c)) for k, c in (("ka", "copies_a"), ("kb", "copies_b")))
    return scratch.finish(linked.join(a, "ka").join(b, "kb").select(F.col("ka").alias("key_a"), F.col("kb").alias("key_b"), "copies_a", "copies_b"))


def _copies(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep_key, copies): the distinct (id, text) rows of each class."""
    rows = signed.where("n > 0 AND id IS NOT NULL").select("n", "fa", "fb", "id", "key").distinct()
    return rows.groupBy("n", "fa", "fb").agg(F.count("*").alias("copies")).join(classes.select("n", "fa", "fb", "rep_key"), ["n", "fa", "fb"]).select("rep_key", "copies")


def _check(rows: DataFrame, pairs: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Verified pairs, written; reads the texts of the candidates alone. Short sets decide all pairs but those that
    a few shingles could decide: these are looked at again on whole sets."""

    def verified(pairs, short):
        keys = scratch.write(_keys(pairs))
        sets = scratch.write(_sets(rows, keys, width, short))
        found = scratch.write(_verify(pairs, sets, percent))
        scratch.drop(keys, sets)
        return found

    first = verified(pairs, True)
    again = verified(first.where("NOT sure").select("ka", "kb"), False)
    out = scratch.write(first.where("sure").unionByName(again).select("ka", "kb"))
    scratch.drop(first, again)
    return out


def _as_ids(links: DataFrame, ids: DataFrame) -> DataFrame:
    a, b = (ids.select(F.col("key").alias(k), F.col("id").alias(i)) for k, i in (("ka", "a"), ("kb", "b")))
    return links.join(a, "ka").join(b, "kb").select("a", "b")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return join(docs).drop("key")
