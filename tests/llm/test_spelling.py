"""Spelling variants against a brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import spelling
from larder.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"


def counted(rows, least=spelling.LEAST_COUNT):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words):
    out = {}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for w, n in words.items():
        others = [x for size in (len(w) - 1, len(w), len(w) + 1) for x in by_size.get(size, []) if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = [form, n, len(others), words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.append(root)
    return out


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in rows}


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.mark.parametrize("frequent", [1, 3, 40, 512])
def test_against_brute_force(spark, frequent):
    """Few letters, so that words with and without a bound, hot grams and chains of forms all occur."""
    import random
    rng = random.Random(frequent)
    words = {}
    for _ in range(700):
        w = "".join(rng.choices("abé", k=rng.randint(7, 10)))
        words[w] = rng.choice([2, 3, 25, 400, 5000])
    words |= {w: 10 ** k for k, w in enumerate(["xstraat", "straat", "straaat", "straaats", "straaatsy"], 1)}
    assert found(spelling.group_variants(table(spark, words), frequent=frequent)) == brute(words)


def test_words_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(spelling.op11_spelling(spark, SF)) == brute(counted(rows))


def test_both_paths_are_taken(spark):
    """Words of rare parts have a bound, words of common ones have none; they meet each other."""
    words = {f"{a}{b}{c}": 5 for a in ("onto", "into", "unto") for b in "xyz" for c in ("over", "ever", "aver")}
    dictionary = spelling.gram_dictionary(table(spark, words), frequent=3)
    bounds = {r.word: r.bound for r in spelling.border_grams(table(spark, words), dictionary).collect()}
    assert 0 in bounds.values()
    words |= {"quizzical": 50, "quizzicall": 2, "ontoxovr": 2}
    dictionary = spelling.gram_dictionary(table(spark, words), frequent=3)
    bounds = {r.word: r.bound for r in spelling.border_grams(table(spark, words), dictionary).collect()}
    assert bounds["quizzical"] == 1
    assert found(spelling.group_variants(table(spark, words), frequent=3)) == brute(words)


def test_lists_are_bounded_by_the_pruning(spark):
    words = {f"{a:03d}".translate(str.maketrans("0123456789", "abcdefghij")) + "ending": 3 for a in range(600)}
    dictionary = spelling.gram_dictionary(table(spark, words), frequent=20)
    keys = spelling.border_grams(table(spark, words), dictionary).where("key IS NOT NULL").groupBy("key").count()
    assert keys.agg(F.max("count")).first()[0] <= 20


def test_odd_rows(spark, docs):
    """Nulls, empty and very long texts, repeated rows, one very long word."""
    rows = [(1, None), (None, "Abcdefgh abcdefgh Abcdefgx"), (2, ""), (3, "ABCDEFGH " * 400), (3, "ABCDEFGH " * 400),
            (4, "z" * 5000 + " " + "z" * 5001), (5, "z" * 5000 + " " + "z" * 5001), (6, "×÷ßÿàéî ×÷ßÿàéî"), (7, "word " * 20000 + "abcdefg abcdefg")]
    words = spelling.corpus_words(docs(rows)).where("n >= 2")
    want = counted(rows)
    assert {r.word: r.n for r in words.collect()} == want
    assert found(spelling.group_variants(words)) == brute(want)


def test_empty_table(spark, docs):
    words = spelling.corpus_words(docs([(1, "a")]).limit(0))
    assert spelling.group_variants(words).count() == 0


def test_pairs_are_unique_and_verified(spark):
    words = {"abcdefgh": 5, "abcdefgx": 5, "abcdefghh": 5, "bacdefgh": 5, "abcdefg": 5}
    pairs = spelling.near_pairs(table(spark, words), Scratch(spark, "test-pairs")).collect()
    want = {(a, b) for a in words for b in words if a < b and near(a, b)}
    assert len(pairs) == len(want) and {(p.a, p.b) for p in pairs} == want
