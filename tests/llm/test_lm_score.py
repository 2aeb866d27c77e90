import collections
import math
import re
import zlib

import pytest

from larder.llm import lm_score as L
from larder.llm.scratch import Scratch, crc_mod
from tests.llm.conftest import fold

END = object()


def brute(rows):
    toks = [re.findall(r"[^\x20\x09-\x0D]+", fold(t)) + [END] for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    c = collections.Counter(x for t, h in zip(toks, held) if not h for x in t)
    n, v = sum(c.values()), len(c)
    return sorted(((i, h, len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)) for (i, _), t, h in zip(rows, toks, held)), key=str)


def run(spark, docs):
    docs = docs.withColumn("held_out", crc_mod("doc_id", 10) == 0)
    scratch = Scratch(spark, "lm-test")
    texts = docs.where("NOT held_out").select("text")
    counts = scratch.write(L.count_tokens(texts))
    known = L.head_of(counts)
    return L.score_texts(docs, ["doc_id", "held_out"], counts, known, L.train(texts, known), scratch)


@pytest.mark.parametrize("head", [1 << 18, 40])
def test_base_score_matches_brute_force(spark, docs, monkeypatch, head):
    monkeypatch.setattr(L, "HEAD", head)
    rows = [(i, f"The cat {i} sat on the mat {i % 7}\n" * (i % 4) + "é Ünï word" * (i % 2)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t"), (5, rows[5][1]), (203, "x " * 3000), (None, "lost words")]
    got = sorted((tuple(r) for r in run(spark, docs(rows)).collect()), key=str)
    for g, w in zip(got, brute(rows)):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9)
        assert math.isfinite(g[6]) and g[6] < 0


def test_no_training_tokens_and_empty_table(spark, docs):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = run(spark, docs([(i, "a b") for i in held])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(3, 0, 0)] * 2
    assert run(spark, docs([])).count() == 0


def test_model_beats_the_unigram_on_held_out_text(spark):
    rows = L.op1_lm_score(spark, "/root/testdata/sf0.01").where("held_out").collect()
    tokens = sum(r["n_tokens"] for r in rows)
    assert 10 ** (-sum(r["score"] for r in rows) / tokens) < 0.9 * 10 ** (-sum(r["base_score"] for r in rows) / tokens)


def test_probabilities_add_up(spark, docs):
    import numpy as np
    rows = [(i, f"a b c{i % 5} a b") for i in range(50)]
    texts = docs(rows).select("text")
    known = L.head_of(Scratch(spark, "lm-test").write(L.count_tokens(texts)))
    scorer = L._Scorer(L.train(texts, known))
    feats, words = L._features(np.array([0, 1, 2, L.RARE]), np.array([0, 4]))
    assert np.allclose(scorer.classes(feats).sum(axis=1), 1, atol=1e-5)
    assert np.allclose(scorer.words(words(np.array([0, 1]), np.array([0, 0])), np.array([0, 0])).sum(axis=1), 1, atol=1e-5)


def test_many_tokens_of_one_count_do_not_empty_the_head(spark, docs, monkeypatch):
    """More tokens of one count than the head holds: it takes the most frequent ones, then as many as fit."""
    monkeypatch.setattr(L, "HEAD", 300)
    texts = docs([(i, f"the once{2 * i} of once{2 * i + 1}") for i in range(1, 601)]).select("text")
    counts = Scratch(spark, "lm-test").write(L.count_tokens(texts))
    known = L.head_of(counts)
    assert 280 < len(known.n) <= 300 and sorted(known.n)[-3:] == [600] * 3 and (known.short != L.RARE).all()
    rows = {r["code"] & (1 << 64) - 1: r["n"] for r in counts.collect()}
    once = sorted(c for c, n in rows.items() if n == 1)
    assert [c for c in known.code.tolist() if rows[c] == 1] == once[:len(known.code) - 3]
