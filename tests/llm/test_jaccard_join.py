import random
import re

import pytest

from larder.llm import jaccard_join as J
from tests.llm.conftest import fold


def brute(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in range(len(rows)):
        for q in range(p):
            if rows[p][0] is None or rows[q][0] is None:
                continue
            both = len(sets[p] & sets[q])
            if both and 100 * both >= percent * len(sets[p] | sets[q]):
                x, y = sorted((find(rows[p][0]), find(rows[q][0])))
                root[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=str)


def check(docs, rows, width=4, percent=85):
    got = sorted((tuple(r) for r in J.join(docs(rows), width=width, percent=percent).drop("key").collect()), key=str)
    assert got == brute(rows, width, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies(docs, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    line = [word() for _ in range(25)]
    rows, i = [], 0
    for _ in range(6):
        base = [word() for _ in range(rng.choice([8, 30, 60]))]
        for _ in range(rng.choice([1, 5, 30])):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = word()
            rows.append((i, " ".join(text + (line if rng.random() < 0.3 else []))))
            i += 1
    rng.shuffle(rows)
    check(docs, rows)
    check(docs, rows, 2, 60)


def test_edges(docs):
    check(docs, [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, "a b c d"), (7, "A b C d"), (7, "A b C d"), (None, "a b c d"),
                 (8, "é ö a b c d e"), (9, "x y " * 300), (10, "y x " * 301), (11, "b a")])
    check(docs, [])


def test_links_inside_a_group_that_holds_its_prefix_alone(docs):
    # of each three texts with one rare part, A and C alone are near; the rest is in other texts too, so prefixes are equal
    common, swap, other = ([f"{c}{k}" for k in range(n)] for c, n in (("p", 76), ("q", 8), ("r", 80)))
    rows = []
    for k in range(12):
        rare = [f"rare{k}x{j}" for j in range(20)]
        rows += [(3 * k + j, " ".join(rare + rest)) for j, rest in enumerate((common + swap[:4], other, common + swap[4:]))]
    rng = random.Random(3)
    for _ in range(2):
        table = docs(rows).coalesce(1)
        got = sorted((tuple(r) for r in J.join(table, width=1).drop("key").collect()), key=str)
        assert got == brute(rows, 1, 85)
        ids = [i for i, _ in rows]
        rng.shuffle(ids)
        rows = [(i, t) for i, (_, t) in zip(ids, rows)]


def test_one_rare_part_in_many_texts(docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4, raising=False)
    rng = random.Random(4)
    pool, rare = [f"p{k}" for k in range(92)], [f"rare{k}" for k in range(20)]
    rows = [(k, " ".join(rare + rng.sample(pool, 80))) for k in range(30)]
    rows += [(100 + k, " ".join(rng.sample(pool, 40))) for k in range(80)]
    want = brute(rows, 1, 85)
    assert 1 < len({c for i, _, c in want if i < 30}) < 30
    got = sorted((tuple(r) for r in J.join(docs(rows).coalesce(1), width=1).drop("key").collect()), key=str)
    assert got == want


def test_all_links_of_a_near_copy_cluster(docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(f"x{k}" if rng.random() < 0.02 else w for w in base)) for k in range(25)]
    rows += [(30, rows[0][1]), (31, rows[0][1]), (31, rows[0][1]), (None, rows[0][1]), (32, None), (33, "alone here and now")]
    sets = {(i, t): {tuple(t.split()[k:k + 4]) for k in range(len(t.split()) - 3)} for i, t in rows if i is not None and t}
    near = lambda p, q: 100 * len(p & q) >= 85 * len(p | q)
    want = {r: sum(near(s, o) for other, o in sets.items() if other != r) for r, s in sets.items()}
    table = docs(rows)
    texts = [(i, t, want.get((i, t), 0)) for i, t in rows]
    got = J.join(table, links=True).collect()
    assert sorted(((r["doc_id"], r["n_links"]) for r in got), key=str) == sorted(((i, n) for i, _, n in texts), key=str)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, 4, 85)
    pairs = [tuple(r) for r in J.class_links(table).select("key_a", "key_b", "copies_a", "copies_b").collect()]
    classes = {frozenset(s) for s in sets.values()}
    assert len({p[:2] for p in pairs}) == len(pairs) == sum(near(a, b) for a in classes for b in classes if a != b) // 2
    copies = lambda s: sum(o == s for o in sets.values())
    assert sum(a * b for _, _, a, b in pairs) == sum(copies(a) * copies(b) for a in classes for b in classes if a != b and near(a, b)) // 2


def test_short_sets_leave_doubtful_pairs_to_whole_ones(docs, monkeypatch):
    """Whatever the low halves of the hashes say, the links are those of the whole sets."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(f"x{rng.randrange(99)}" if rng.random() < 0.03 else w for w in base)) for k in range(40)]
    want = brute(rows, 4, 85)
    whole = J.W.sequence_codes

    def clash(code, begin, length, second=False):       # low halves take few values
        made = whole(code, begin, length, second)
        return (made & J.np.uint64(0xFFFFFFFF00000000)) | (made & J.np.uint64(0x3FF))

    monkeypatch.setattr(J.W, "sequence_codes", clash)
    got = sorted((tuple(r) for r in J.join(docs(rows)).drop("key").collect()), key=str)
    assert got == want


def test_rows_are_picked_by_a_shuffle_beyond_the_broadcast(docs, monkeypatch):
    monkeypatch.setattr(J, "MAX_KEYS", 0)
    rng = random.Random(9)
    base = [[f"w{j}x{k}" for k in range(30)] for j in range(4)]
    rows = [(k, " ".join(f"x{rng.randrange(99)}" if rng.random() < 0.02 else w for w in base[k % 4])) for k in range(60)]
    check(docs, rows)


def test_rows_of_one_id_and_other_texts_apart(docs):
    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    rows = [(7, a), (7, b), (8, a + " more"), (9, b), (9, b), (10, None), (None, a)]
    got = {(r.doc_id, r.key): r.component_id for r in J.join(docs(rows), apart=True).collect()}
    groups = {}
    for (i, _), c in got.items():
        groups.setdefault(c, []).append(i)
    assert sorted(sorted(map(str, g)) for g in groups.values()) == [["10"], ["7", "8"], ["7", "9"], ["None"]]
    assert {r.component_id for r in J.join(docs(rows)).where("doc_id IN (7, 8, 9)").collect()} == {7}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in J.op8_jaccard_join(spark, sf).collect()), key=str) == brute(rows, 4, 85)


def test_histograms_bound_what_sets_share():
    rng = J.np.random.default_rng(2)
    for n in (1, 3, 40, 700, 30_000):
        x = rng.integers(0, 1 << 63, n, dtype=J.np.uint64)
        y = J.np.unique(J.np.concatenate([x[:n // 2], rng.integers(0, 1 << 63, n + n // 3, dtype=J.np.uint64)]))
        x = J.np.unique(x)
        both = J.np.concatenate([x, y])
        a, b = J._histograms(J.np.repeat([0, 1], [len(x), len(y)]), both, J.np.array([len(x), len(y)]))
        most = J._most_shared(a, b)
        assert len(J.np.intersect1d(x, y)) <= most <= min(len(x), len(y)) and J._most_shared(b, a) == most and J._most_shared(a, a) == len(x)
    same = J.np.arange(300, dtype=J.np.uint64) << J.np.uint64(20)       # all in one bin: a byte does not hold their number
    assert J._histograms(J.np.zeros(300, J.np.int64), same, J.np.array([300])) == [b""] and J._most_shared(b"", b"\1") is None
