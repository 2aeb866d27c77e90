"""The conversation trie against a plain trie of Python dictionaries."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from larder.llm import conversation_trie as C
from larder.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"


def digest(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        rows.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(len(p) == len(path) + 1 for p in below), len(leaves), saved,
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, conv string")


def found(spark, rows, **kw):
    turns, convs = C.rebuilt_turns(C.ranked_turns(table(spark, rows)))
    return sorted((tuple(r) for r in C.prefix_trie(turns, convs, Scratch(spark, "trie-test"), **kw).select(COLUMNS).collect()), key=str)


def some(rng, convs, texts, most):
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(texts)) for c in convs for t in range(rng.randint(1, most))]


@pytest.mark.parametrize("tree_turns", [1, 40, 1 << 16])
def test_against_brute_force(spark, tree_turns):
    rng = random.Random(tree_turns)
    rows = some(rng, range(0, 90), ["a", "bé", ""], 6) + some(rng, range(-9, 0), ["a", "日本"], 12)
    assert found(spark, rows, tree_turns=tree_turns) == brute(rebuilt(rows))


def test_long_conversations_cross_segments(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 7)
    rng = random.Random(3)
    long = [(c, t, "user", f"turn {t if t < 70 + c % 3 else rng.random()}") for c in range(40, 48) for t in range(50 + 30 * (c % 4))]
    exact = [(c, t, "user", "same") for c in (100, 101, 105) for t in range(C.SEGMENT * 2)]
    assert found(spark, long + exact) == brute(rebuilt(long + exact))


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, equal turn numbers, repeated rows, a missing first conversation, a very long text."""
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, None, "user", None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (0, 5, "user", "long " * 50000), (0, 6, "user", ""), (3, 0, "user", "q"), (7, 0, "user", "only"), (9, 0, "user", "only"), (12, 2, "a", "b")]
    rows += [(c, t, "user", "shared") for c in range(20, 60) for t in range(2)]
    assert any(not turns for turns in rebuilt(rows).values())
    assert found(spark, rows) == brute(rebuilt(rows))


def test_empty_table(spark):
    assert found(spark, [(1, 1, "a", "b")][:0] or [(None, 1, "a", "b")]) == []


def test_members_of_one_node_in_pieces(spark, monkeypatch):
    """Conversations that end at one node are hashed in order, over all pieces."""
    monkeypatch.setattr(C, "PIECE", 5)
    ends = spark.range(1, 2001).select(F.lit(3).cast("long").alias("depth"), (F.col("id") % 2).alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("id").alias("conv"))
    got = {r.h1: r.digest for r in C._digests(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(str(c) for c in range(1, 2001) if c % 2 == k).encode()).hexdigest() for k in (0, 1)}


def test_layouts_grow_and_paths_are_compressed():
    rng = random.Random(1)
    keys = [bytes([1, 2, a, b]) for a in range(256) for b in rng.sample(range(256), rng.choice([1, 4, 5, 16, 17, 48, 49, 256]))] + [b"\1", b"\1\2\3", b"\1\2"]
    tree = C.Tree()
    for conv, key in enumerate(keys):
        tree.insert(key).end(conv, (1, 0))
    seen, layouts = {}, set()
    for node, above, path in tree.walk():
        layouts.add(node.layout)
        assert len(node.children()) <= node.layout
        assert node.n or len(node.children()) > 1                # else it would be compressed
        if node.n:
            seen[bytes(path) + node.prefix] = node.n
    assert seen == {k: 1 for k in keys} and layouts == {4, 16, 48, 256}
    tree.add_up()
    assert tree.root.n == len(keys) and tree.root.least == 0


def test_query_matches_sql_and_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in C.op13_conversation_trie(spark, SF).select(COLUMNS).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    cur = con.execute(C.ORACLE)
    assert [d[0] for d in cur.description] == COLUMNS
    assert got == brute(rebuilt(rows)) == sorted(cur.fetchall(), key=str)
