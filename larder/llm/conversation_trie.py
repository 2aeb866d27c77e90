"""Prefix trie of conversations: which first turns they share, and what sharing them saves.

A turn's id is a digest of its role and text, ``ID_BYTES`` wide and read big-endian; a
conversation is the string of its turns' ids. Tasks insert such strings into adaptive radix trees
(``Tree``): nodes hold 4, 16, 48 or 256 children and change their layout as they grow, and bytes without a branch lie
compressed in one node. A tree has a node wherever bytes differ, also within an id; only
depths that are a whole number of ids come out as nodes of the trie.

No task needs a whole trie. A conversation is cut into segments of ``SEGMENT`` turns; a segment's key begins with its
depth and the hash of all turns before it, so it needs none of them. A task fills a tree
with up to ``TREE_TURNS`` turns of any segments, hands its nodes on and begins a new one; a node is named by
its depth and the hash of its path, and the rows of equal nodes are added up. A first turn that
most conversations share is one row per tree before the shuffle.

Sums over subtrees need no walk over the whole trie. Each node belongs to its smallest member, which then
owns all nodes of its own path from there on; so what a subtree holds once per node is
a sum over the members of its top: of the nodes each of them owns. The sums over members come out of a second round of trees.

Hashes of paths have 128 bits, ids too: unequal ones are taken for equal with a chance of about 2**-64 in
a table of 2**32 turns.

Defined cases: rows with a null conv_id are no conversation and left out; a null role or text is empty; a null
turn comes first; turns of equal number are in order of the digest of role and text; repeated rows are turns of their own;
the first turns of a conversation come from that of conv_id - conv_id mod 5 (mod of 0 to 4, also of negative ids); texts
may be of any length, only their digests and sizes move; an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch

ID_BYTES = 16
BLOCK = 512                  # turn numbers that one task orders together
SEGMENT = 64                 # turns of a segment
TREE_TURNS = 1 << 16         # turns in a task's tree
HEAD = 4 + 8 + 8             # bytes before the ids of a key: segment number, hash of what is before
GROUP, MOST_GIVEN = 5, 9     # conversations that share first turns; how many they share is below MOST_GIVEN
PIECE = 1 << 16              # characters of member ids that are handed on together
NONE = hashlib.sha256(b"").hexdigest()


# --- the tree ---------------------------------------------------------------

class Node:
    """A radix node: compressed bytes, children by next byte, and the sums of the keys that end here."""

    __slots__ = ("prefix", "layout", "keys", "kids", "n", "least", "of_least", "sums")

    def __init__(self, prefix: bytes):
        self.prefix = prefix
        self.layout, self.keys, self.kids = 4, bytearray(), []
        self.n, self.least, self.of_least, self.sums = 0, None, 0, (0, 0)

    def child(self, byte: int):
        if self.layout <= 16:
            at = self.keys.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> None:
        """Set the child of a byte; a full layout gives way to the next larger one first."""
        if self.layout <= 16:
            at = self.keys.find(byte)
            if at >= 0:
                self.kids[at] = node
                return
            if len(self.kids) == self.layout:
                self._grow()
                self.put(byte, node)
                return
            at = sum(b < byte for b in self.keys)
            self.keys.insert(at, byte)
            self.kids.insert(at, node)
        elif self.layout == 48:
            at = self.keys[byte]
            if at:
                self.kids[at - 1] = node
            elif len(self.kids) == 48:
                self._grow()
                self.put(byte, node)
            else:
                self.kids.append(node)
                self.keys[byte] = len(self.kids)
        else:
            self.kids[byte] = node

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray(256)                   # byte -> 1 + place of its child
            for place, byte in enumerate(self.keys, 1):
                index[byte] = place
            self.layout, self.keys = 48, index
        else:
            kids = [None] * 256
            for byte, place in enumerate(self.keys):
                if place:
                    kids[byte] = self.kids[place - 1]
            self.layout, self.keys, self.kids = 256, bytearray(), kids

    def children(self) -> list[Node]:
        return [kid for kid in self.kids if kid is not None]

    def end(self, conv: int, sums: tuple[int, int]) -> None:
        self.n += 1
        self.sums = (self.sums[0] + sums[0], self.sums[1] + sums[1])
        if self.least is None or conv < self.least:
            self.least, self.of_least = conv, sums[0]

    def take(self, other: Node) -> None:
        """Add the sums of a child."""
        self.n += other.n
        self.sums = (self.sums[0] + other.sums[0], self.sums[1] + other.sums[1])
        if self.least is None or (other.least is not None and other.least < self.least):
            self.least, self.of_least = other.least, other.of_least


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


class Tree:
    """Adaptive radix tree over byte strings of which one may be the beginning of another."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes) -> Node:
        """The node at which ``key`` ends."""
        node, at = self.root, 0
        while at < len(key):
            child = node.child(key[at])
            if child is None:
                new = Node(key[at:])
                node.put(key[at], new)
                return new
            rest = key[at:at + len(child.prefix)]
            same = _common(child.prefix, rest)
            if same < len(child.prefix):             # cut the compressed path in two
                upper = Node(child.prefix[:same])
                child.prefix = child.prefix[same:]
                upper.put(child.prefix[0], child)
                node.put(key[at], upper)
                child = upper
            node, at = child, at + same
        return node

    def walk(self):
        """(node, depth of its parent, path of bytes to its parent) of all nodes but the root, parents first."""
        stack = [(kid, 0) for kid in reversed(self.root.children())]
        path = bytearray()
        while stack:
            node, above = stack.pop()
            del path[above:]
            yield node, above, path
            path += node.prefix
            stack += [(kid, len(path)) for kid in reversed(node.children())]

    def add_up(self) -> None:
        """Let every node's sums be those of all keys at or below it."""
        order = [(self.root, None)]
        for node, parent in order:                   # grows as it is read: parents before children
            order += [(kid, node) for kid in node.children()]
        for node, parent in reversed(order):
            if parent is not None:
                parent.take(node)


NODE = "depth long, h1 long, h2 long, p1 long, p2 long, n long, conv long, of_least long, sum1 long, sum2 long, size long, before long"


def tree_nodes(segments: DataFrame, tree_turns: int = TREE_TURNS) -> DataFrame:
    """Nodes of the tasks' trees, columns NODE: name of the node and of its parent, members, the smallest of
    them and its w1, sums of w1 and w2 over them, bytes of the last text, bytes of all texts before it."""

    def flush(tree, turns, heads):
        tree.add_up()
        columns = [array("q") for _ in range(12)]
        line = []                                    # per id on the path, the segment's root first: (h1, h2, bytes of the path)
        for node, above, path in tree.walk():
            whole = bytes(path) + node.prefix
            if len(whole) < HEAD:
                continue
            head = whole[:HEAD]
            segment = int.from_bytes(head[:4], "big")
            if above < HEAD:
                line = [(*_signed(head), heads[head])]
                if segment == 0:
                    _add(columns, 0, line[0], line[0], node, 0)
            del line[1 + max(0, above - HEAD) // ID_BYTES:]
            for at in range(HEAD + (len(line) - 1) * ID_BYTES, len(whole) - ID_BYTES + 1, ID_BYTES):
                depth = segment * SEGMENT + len(line)
                h1, h2, size = turns[depth, whole[at:at + ID_BYTES]]
                up = line[-1]
                line.append((up[0] ^ h1, up[1] ^ h2, up[2] + size))
                _add(columns, depth, line[-1], up, node, size)
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in NODE.split(", ")])

    def grow(batches):
        tree, turns, heads, filled = Tree(), {}, {}, 0
        for batch in batches:
            for row in range(len(batch)):
                conv, segment, h1, h2, before, w1, w2, list_ = (batch.column(k)[row].as_py() for k in range(8))
                head = segment.to_bytes(4, "big") + _unsigned(h1) + _unsigned(h2)
                heads[head] = before
                for depth, t in enumerate(list_, segment * SEGMENT + 1):
                    turns[depth, t["id"]] = (t["h1"], t["h2"], t["size"])
                tree.insert(head + b"".join(t["id"] for t in list_)).end(conv, (w1, w2))
                filled += 1 + len(list_)
                if filled >= tree_turns:
                    yield flush(tree, turns, heads)
                    tree, turns, heads, filled = Tree(), {}, {}, 0
        if filled:
            yield flush(tree, turns, heads)

    return segments.select("conv", "segment", "h1", "h2", "before", "w1", "w2", "turns").mapInArrow(grow, NODE)


def _unsigned(x: int) -> bytes:
    return (x & ((1 << 64) - 1)).to_bytes(8, "big")


def _signed(head: bytes) -> tuple[int, int]:
    return int.from_bytes(head[4:12], "big", signed=True), int.from_bytes(head[12:20], "big", signed=True)


def _add(columns, depth, own, parent, node, size) -> None:
    values = (depth, own[0], own[1], parent[0], parent[1], node.n, node.least, node.of_least, node.sums[0], node.sums[1], size, parent[2])
    for column, value in zip(columns, values):
        column.append(value)


# --- rebuilt conversations ---------------------------------------------------

def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv, i, id, size): turns numbered from 0 within their conversation. Numbers come from
    blocks of turns first, so a huge conversation is spread over tasks."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(digest, 1, 2 * ID_BYTES)).alias("id"), F.octet_length(text).cast("long").alias("size"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60))))
    sums = rows.groupBy("conv", "block").agg(F.count("*").alias("turns"))
    past = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("turns").over(past), F.lit(0)).alias("lead"))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "id")
    rows = rows.withColumn("place", F.row_number().over(inside) - 1)
    return rows.join(sums, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv", (F.col("lead") + F.col("place")).alias("i"), "id", "size")


def given(conv: Column) -> Column:
    """How many first turns a conversation takes from its group's first one."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_GIVEN


def rebuilt_turns(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, i, id, size) of the rebuilt conversations, and all conversations (conv)."""
    sizes = ranked.groupBy("conv").agg(F.count("*").alias("n"))
    convs = sizes.select("conv", given(F.col("conv")).alias("h"), (F.col("conv") - F.pmod(F.col("conv"), F.lit(GROUP))).alias("base"))
    firsts = ranked.where((F.col("i") < MOST_GIVEN - 1) & (F.pmod(F.col("conv"), F.lit(GROUP)) == 0)).select(F.col("conv").alias("b"), "i", "id", "size")
    lent = convs.join(firsts, (F.col("base") == F.col("b")) & (F.col("i") < F.col("h"))).select("conv", "i", "id", "size")
    there = sizes.select(F.col("conv").alias("b"), F.col("n").alias("base_n"))
    lead = convs.join(there, F.col("base") == F.col("b"), "left").select(
        F.col("conv").alias("c"), "h", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))).alias("lead"))
    own = ranked.join(lead, F.col("conv") == F.col("c")).where("i >= h").select("conv", (F.col("i") - F.col("h") + F.col("lead")).alias("i"), "id", "size")
    return lent.unionByName(own), convs.select("conv")


def segments_of(turns: DataFrame, convs: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv, segment, h1, h2, before, turns, n, x1, x2, bytes): the turns of each segment, hash and bytes of
    all turns before it, and number, hash and bytes of its own. A conversation without turns has one empty segment."""
    half = ID_BYTES // 2
    lanes = [F.xxhash64(F.substring("id", 1 + k * half, half), "i").alias(f"h{k + 1}") for k in range(2)]
    rows = turns.select("conv", F.floor(F.col("i") / length).cast("int").alias("segment"), "i", "id", *lanes, "size")
    made = rows.groupBy("conv", "segment").agg(
        F.sort_array(F.collect_list(F.struct("i", "id", "h1", "h2", "size"))).alias("turns"), F.count("*").alias("n"),
        F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum("size").alias("bytes"))
    past = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda total: F.coalesce(total.over(past), F.lit(0).cast("long"))
    made = made.select("conv", "segment", upto(F.bit_xor("x1")).alias("h1"), upto(F.bit_xor("x2")).alias("h2"), upto(F.sum("bytes")).alias("before"),
                       "turns", "n", "x1", "x2", "bytes")
    zero = F.lit(0).cast("long")
    silent = convs.join(made.where("segment = 0").select("conv"), "conv", "left_anti").select(
        "conv", F.lit(0).alias("segment"), zero.alias("h1"), zero.alias("h2"), zero.alias("before"),
        F.array().cast(made.schema["turns"].dataType).alias("turns"), zero.alias("n"), zero.alias("x1"), zero.alias("x2"), zero.alias("bytes"))
    return made.unionByName(silent)


# --- the trie ---------------------------------------------------------------

NAME = ["depth", "h1", "h2"]


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, digest): SHA-256 of the ascending, comma-joined conv of each node.
    The ids are sorted and joined in ranges, which may split a node; what is left for one task per node is
    to hash the joined pieces one after another, without holding them."""

    def joined(batches):
        name, first, ids, size = None, None, [], 0
        for batch in batches:
            for *at, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if at != name or size > PIECE:
                    if ids:
                        yield _row([*name, first, ",".join(ids)], PIECES)
                    name, first, ids, size = at, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield _row([*name, first, ",".join(ids)], PIECES)

    def hashed(batches):
        name, state = None, None
        for batch in batches:
            for *at, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if at != name:
                    if state is not None:
                        yield _row([*name, state.hexdigest()], DIGESTS)
                    name, state = at, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
        if state is not None:
            yield _row([*name, state.hexdigest()], DIGESTS)

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    pieces = ends.select(*NAME, "conv").repartitionByRange(parts, *NAME, "conv").sortWithinPartitions(*NAME, "conv").mapInArrow(joined, PIECES)
    return pieces.repartition(parts, *NAME).sortWithinPartitions(*NAME, "first").mapInArrow(hashed, DIGESTS)


PIECES = "depth long, h1 long, h2 long, first long, text string"
DIGESTS = "depth long, h1 long, h2 long, digest string"


def _row(values: list, schema: str):
    return pa.record_batch([pa.array([v]) for v in values], names=[c.split()[0] for c in schema.split(", ")])


def prefix_trie(turns: DataFrame, convs: DataFrame, scratch: Scratch, tree_turns: int = TREE_TURNS) -> DataFrame:
    """One row per distinct prefix of the conversations ``turns`` (conv, i, id, size); ``convs`` (conv) names them all."""
    segments = scratch.write(segments_of(turns, convs))
    totals = scratch.write(segments.groupBy("conv").agg(F.sum("n").alias("depth"), F.bit_xor("x1").alias("h1"), F.bit_xor("x2").alias("h2"), F.sum("bytes").alias("bytes")))
    no = F.lit(0).cast("long")
    found = tree_nodes(segments.withColumns({"w1": no, "w2": no}), tree_turns)
    same = [F.min(c).alias(c) for c in ("p1", "p2", "size", "before")]       # equal in all rows of a node
    nodes = scratch.write(found.groupBy(*NAME).agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *same))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("d_"), F.col("p1").alias("h1_"), F.col("p2").alias("h2_")).agg(F.count("*").alias("kids"))
    nodes = scratch.write(nodes.join(kids, _named("_"), "left").select(*nodes.columns, F.coalesce("kids", no).alias("kids")))
    # what each conversation owns, and what it only shares
    owned = nodes.groupBy("conv").agg(F.sum("size").alias("own"), F.sum((F.col("kids") == 0).cast("long")).alias("leaf"))
    weights = totals.join(owned, "conv", "left").select(
        F.col("conv").alias("c"), (F.col("bytes") - F.coalesce("own", no)).alias("w1"), F.coalesce("leaf", no).alias("w2"))
    summed = tree_nodes(segments.join(weights, F.col("conv") == F.col("c")), tree_turns).groupBy(*[F.col(c).alias(f"{c}_") for c in NAME]).agg(
        F.sum("sum1").alias("shared"), F.sum("sum2").alias("leaves"), F.min(F.struct("conv", "of_least"))["of_least"].alias("of_least"))
    above = nodes.select(*[F.col(c).alias(f"{c}_") for c in NAME], F.col("conv").alias("parent"))
    ends = _digests(totals).select(*[F.col(c).alias(f"{c}_") for c in NAME], "digest")
    out = nodes.join(summed, _named("_", "depth_")).drop("depth_", "h1_", "h2_")
    out = out.join(ends, _named("_", "depth_"), "left").drop("depth_", "h1_", "h2_")
    out = out.join(above, (F.col("depth") - 1 == F.col("depth_")) & (F.col("p1") == F.col("h1_")) & (F.col("p2") == F.col("h2_")), "left")
    return scratch.finish(out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("shared") - F.col("of_least") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("digest", F.lit(NONE)).alias("ends_sha256")))


def _named(tail: str, depth: str = "d_") -> Column:
    return (F.col("depth") == F.col(depth)) & (F.col("h1") == F.col(f"h1{tail}")) & (F.col("h2") == F.col(f"h2{tail}"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "conversation-trie")
    ranked = scratch.write(ranked_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))
    turns, convs = rebuilt_turns(ranked)
    return prefix_trie(turns, convs, scratch)


ORACLE = r"""
WITH own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS i, id, size FROM (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL)),
cs AS (SELECT c, c - ((c % 5) + 5) % 5 AS b, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
  lambda a, x: list_reduce([xor(a, x)] || range(8), lambda y, k: xor(y >> 1, 3988292384 * (y & 1))))) % 9 AS h FROM (SELECT DISTINCT c FROM own)),
sizes AS (SELECT c AS b, count(*) AS nb FROM own GROUP BY c),
turns AS (SELECT cs.c, o.i, o.id, o.size FROM cs JOIN own o ON o.c = cs.b AND o.i <= cs.h
  UNION ALL SELECT o.c, o.i - h + least(h, coalesce(nb, 0)), id, size FROM own o JOIN cs USING (c) LEFT JOIN sizes USING (b) WHERE o.i > h),
paths AS (SELECT c, 0 AS d, '' AS k, '' AS up, 0 AS size FROM cs
  UNION ALL SELECT c, i, sha256(string_agg(id, '') OVER w), CASE WHEN i > 1 THEN sha256(string_agg(id, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) ELSE '' END, size
  FROM turns WINDOW w AS (PARTITION BY c ORDER BY i)),
node AS (SELECT row_number() OVER () AS v, d, k, any_value(up) AS up, min(c) AS conv, count(*) AS n, any_value(size) AS size FROM paths GROUP BY d, k),
member AS (SELECT c, v, d FROM paths JOIN node USING (d, k)),
kids AS (SELECT p.v, count(*) AS n FROM node p JOIN node q ON q.d = p.d + 1 AND q.up = p.k GROUP BY p.v),
below AS (SELECT DISTINCT a.v, b.v AS w FROM member a JOIN member b ON a.c = b.c AND b.d >= a.d),
sums AS (SELECT below.v, sum((node.n - 1) * node.size)::BIGINT AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
  FROM below JOIN node ON node.v = below.w LEFT JOIN kids ON kids.v = below.w GROUP BY below.v),
ends AS (SELECT v, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest FROM member JOIN (SELECT c, max(d) AS d FROM paths GROUP BY c) USING (c, d) GROUP BY v)
SELECT node.conv AS conv_id, node.d::BIGINT AS depth, p.conv AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, sums.leaves AS n_leaves,
  sums.saved AS saved_tokens, coalesce(ends.digest, sha256('')) AS ends_sha256
FROM node JOIN sums USING (v) LEFT JOIN kids USING (v) LEFT JOIN ends USING (v) LEFT JOIN node p ON p.d = node.d - 1 AND p.k = node.up
"""
