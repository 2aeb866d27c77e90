import re

import pytest
from pyspark.sql import functions as F

from larder.llm import decontaminate as D
from tests.llm.conftest import fold

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEM = "Alpha beta gamma, delta epsilon! zeta eta theta iota kappa lambda"
ITEMS = [(1, ITEM), (2, "tiny one"), (3, None), (4, "!!"), (5, "é ö " * 8), (10, ITEM), (1, ITEM), (None, "null item here")]
DOCS = [(1, "x " + ITEM.upper() + " y"), (2, "has a TINY, one inside; tiny-one"), (3, None), (4, ""), (5, "é ö " * 30), (6, "alpha beta gamma delta epsilon zeta eta theta iota"),
        (7, "w " * 50_000 + ITEM + " tiny one"), (7, "w " * 50_000 + ITEM + " tiny one"), (None, "null item here tiny one"), (8, "...")]


def brute(width):
    windows = {}
    for i, t in ITEMS:
        w = re.findall(WORD, fold(t))
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).update([] if i is None else [str(i)])
    out = []
    for doc, text in DOCS:
        w = re.findall(WORD, fold(text))
        hit, who = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k:k + n]))
                if found is not None:
                    hit.update(range(k, k + n))
                    who |= found
        out.append((doc, len(w), len(hit), sorted(who)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,most", [(10, 200_000), (10, 3), (4, 5)])
def test_hits_match_brute_force(spark, docs, width, most):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find(docs(DOCS), items, width=width, max_windows=most)
    n_hit = F.aggregate(F.coalesce("__hits", F.array().cast(D.HITS)), F.lit(0), lambda a, h: a + h["end"] - h["begin"])
    got = [(r["doc_id"], r["__n_words"], r["hit"], r["__items"] or []) for r in found.withColumn("hit", n_hit).collect()]
    assert sorted(got, key=str) == brute(width)


def test_spans_are_cut_from_the_text(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find(docs([(1, "é x, " + ITEM + "; y tiny ONE z"), (2, None), (3, "clean é")]), items)
    got = {r["doc_id"]: r["t"] for r in found.select("doc_id", D.remove_spans("text", "__hits").alias("t")).collect()}
    assert got == {1: "é x, ; y  z", 2: None, 3: "clean é"}


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r["__n_words"] for r in D.find(docs([(1, "a b")]), items).collect()] == [2]
    assert D.find(docs([]), items).count() == 0


def test_items_without_an_id_are_cut_out_too(spark, docs):
    items = spark.createDataFrame([(None, ITEM)], "item_id long, text string")
    row = D.find(docs([(1, "x " + ITEM)]), items).first()
    assert [(h.begin, h.end) for h in row["__hits"]] == [(1, 12)] and row["__items"] == []
