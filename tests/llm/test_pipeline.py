"""Every stage of the pipeline against a brute-force version on a small table."""

import re

import pytest

import corpus_pipeline as P
from tests.llm.conftest import fold
from tests.llm.test_jaccard_join import brute as brute_components
from tests.llm.test_secrets import brute as brute_secrets

SF = "/root/testdata/sf0.001"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, __key long"
ODD = [(9001, None, "en", "s", 0), (9002, "", None, "s", 0), (9003, "12 34 !!", "en", "s", 8), (9004, "token = abcdefgh12 and more words here", None, None, None),
       (9004, "token = abcdefgh12 and more words here", None, None, None), (None, "the and of that with", None, "s", 5)]


@pytest.fixture(scope="module")
def table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(P.COLUMNS).collect()] + ODD
    return rows, spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def texts(df):
    assert df.columns == P.COLUMNS
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_language_stage(spark, table):
    rows, df = table
    out = P.language(spark, df, SF)
    assert texts(out) == sorted(((r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or "")), key=str)
    assert out.where("lang IS NULL").count() == 0


def test_near_duplicate_stage(spark, table):
    rows, df = table
    pairs = [(r[0], r[1]) for r in rows]
    root = {i: c for i, _, c in brute_components(pairs, P.WIDTH, P.PERCENT)}
    stay = {(i, t) for i, t in pairs if i is None or root[i] == i}
    assert texts(P.near_duplicates(spark, df, SF)) == sorted(stay, key=str)


def test_benchmark_stage(spark, table):
    rows, df = table
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = re.findall(WORD, fold(r["text"]))
        windows |= {tuple(w[k:k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)} if w else set()
    want, n_cut = [], 0
    for r in rows:
        found = list(re.finditer(WORD, fold(r[1])))
        hit = set()
        for n in {len(x) for x in windows}:
            for k in range(len(found) - n + 1):
                if tuple(m[0] for m in found[k:k + n]) in windows:
                    hit.update(range(k, k + n))
        if hit and len(hit) >= P.MOSTLY * len(found):
            n_cut += 1
            continue
        text = r[1]
        for k in sorted(hit, reverse=True):
            if k + 1 in hit:
                text = text[:found[k].start()] + text[found[k + 1].start():]
            else:
                text = text[:found[k].start()] + text[found[k].end():]
        n_cut += bool(hit)
        want.append((r[0], text))
    assert n_cut and texts(P.without_benchmarks(spark, df, SF)) == sorted(want, key=str)


def test_secret_stage(spark, table):
    rows, df = table
    want = []
    for r in rows:
        text, merged = r[1], []
        for start, _, end, _ in brute_secrets(r[1]):
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        for start, end in reversed(merged):
            text = text[:start] + "[REDACTED]" + text[end:]
        want.append((r[0], text))
    out = P.without_secrets(spark, df, SF)
    assert texts(out) == sorted(want, key=str)
    for r in out.where("text LIKE '%[REDACTED]%' AND n_chars IS NOT NULL").collect():
        assert r["n_chars"] == len(r["text"])


def test_mixing_stage_takes_effect(spark, table):
    rows, df = table
    out = P.mixed(spark, df, SF).collect()
    assert {r["doc_id"] for r in out} <= {r[0] for r in rows}
    assert all(r["rate"] >= 0.5 and r["n_copies"] >= 1 and abs(r["n_copies"] - r["rate"]) < 1.01 for r in out)


def test_run_and_empty_table(spark, table, tmp_path):
    whole = P.run(spark, SF)
    assert set(P.COLUMNS) <= set(whole.columns) and whole.count() > 50
    for name in ("documents", "benchmark", "labels"):
        source = spark.read.parquet(f"{SF}/{name}.parquet")
        (source.limit(0) if name == "documents" else source).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
