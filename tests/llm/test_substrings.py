import collections
import random
import re

from larder.llm import substrings as S


def brute(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((doc, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def check(docs, rows, length):
    got = sorted((tuple(r) for r in S.remove(docs(rows), length=length).collect()), key=str)
    assert got == brute(rows, length)


def test_random_copies_and_edits(docs):
    rng = random.Random(7)
    base = [f"w{rng.randrange(30)}" for _ in range(400)]
    rows = []
    for i in range(60):
        a = rng.randrange(300)
        part = base[a:a + rng.randrange(5, 100)]
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = f"e{rng.randrange(1000)}"
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(part)))
    check(docs, rows, 12)
    check(docs, rows, 35)


def test_edges(docs):
    long = " ".join(f"x{i}" for i in range(40))
    check(docs, [(1, None), (2, ""), (3, long), (3, long), (4, "é😀 " + long + " ü"), (None, "a b"), (5, "z " * 200), (6, "p q " * 30), (7, long.upper()), (8, " \n ")], 12)
    check(docs, [], 12)
    rng = random.Random(3)
    check(docs, [(1, " ".join(str(rng.randrange(10**6)) for _ in range(60_000))), (2, "only " * 3)], 35)
