import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import mixing as M
from larder.llm.scratch import Scratch


def nnls(points, targets, rounds=200_000):
    """Long plain projected gradient from rate 1: (posterior, tokens) points."""
    p, t = np.array([x[0] for x in points]) / 1000, np.array([x[1] for x in points], float)
    total = t.sum()
    r = np.ones(len(t))
    step = 1 / np.linalg.eigvalsh((p * t[:, None]).T @ p / total).max()
    for _ in range(rounds):
        miss = ((r * t) @ p - targets) / total
        new = np.maximum(0, r - step * (p @ miss))
        if np.abs(new - r).max() < 1e-12:
            break
        r = new
    return ((((r * t) @ p - targets) / total) ** 2).sum(), r


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_rates_reach_the_least_squares_optimum(spark, seed):
    rng = np.random.default_rng(seed)
    cut = np.sort(rng.integers(0, 1001, (40, 2)), axis=1)
    if seed == 2:
        cut[:, 0] = 0                                    # a domain that no document has
    points = [([int(a), int(b - a), int(1000 - b)], int(n)) for (a, b), n in zip(cut, rng.integers(1, 500, 40))]
    targets = [sum(t for _, t in points) * x for x in ((0.1, 0.2, 0.7), (0.0, 0.0, 1.2), (0.3, 0.3, 0.3))[seed]]
    df = spark.createDataFrame(points, "p array<int>, tokens long")
    rates = M.solve(df, targets)
    got = df.select("p", "tokens", rates.of(F.col("p")).alias("r")).collect()
    p, t, r = np.array([x["p"] for x in got]) / 1000, np.array([x["tokens"] for x in got], float), np.array([x["r"] for x in got])
    best, _ = nnls(points, np.array(targets))
    size = ((((r * t) @ p - targets) / t.sum()) ** 2).sum()
    assert (r >= 0).all()
    if seed == 1:                                        # far out of reach: approached, and said so
        begin = (((t @ p - targets) / t.sum()) ** 2).sum()
        assert best <= size < 0.05 * begin and not rates.converged
    else:
        assert size <= best + 1e-5
        assert rates.converged
    assert np.allclose(rates.residual, ((r * t) @ p - targets) / t.sum(), atol=1e-6)


def test_a_fit_that_is_cut_short_says_so(spark):
    df = spark.createDataFrame([([900, 50, 50], 100), ([100, 800, 100], 300), ([10, 10, 980], 50)], "p array<int>, tokens long")
    cut, whole = (M.solve(df, [0.0, 400.0, 10.0], steps=steps) for steps in (3, 60))
    assert not cut.converged and cut.slope > M.ENOUGH and len(cut.steps) < len(whole.steps)
    assert sum(x * x for x in whole.residual) <= sum(x * x for x in cut.residual)


ROWS = [(i, ("scum idiot " if i % 5 == 0 else "| | x x " if i % 5 == 1 else "") + f"plain words number {i % 17} here and there", i % 3) for i in range(400)]


def tables(spark):
    docs = spark.createDataFrame(ROWS + [(900, None, 0), (901, "", 0), (902, "never seen", 0), (902, "never seen", 0), (None, "scum idiot", 0)], "doc_id long, text string, rate int")
    labels = [(i, ["toxic", "low", "high"][min(i % 5, 2)]) for i, _, _ in ROWS if i % 2] + [(1, "high"), (None, "low"), (3, None), (5, "strange")]
    return docs, spark.createDataFrame(labels, "doc_id long, domain string")


def test_mix_finds_domains_and_hits_targets(spark):
    docs, labels = tables(spark)
    report = {}
    out = M.mix(docs.withColumn("__p", F.lit("kept")), labels, {"toxic": 0.0, "low": 0.3, "high": 0.7}, report=report)
    rows = out.collect()
    assert {r["__p"] for r in rows} == {"kept"} and set(report["residual"]) == {"toxic", "low", "high"}
    assert report["converged"] and max(abs(x) for x in report["residual"].values()) < 0.02
    assert len(rows) == len(ROWS) + 5
    total = sum(r["n_tokens"] for r in rows)
    for d, share in (("low", 0.3), ("high", 0.7), ("toxic", 0.0)):
        assert abs(sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) / total - share) < 0.02
    for r in rows:
        assert abs(r["p_toxic"] + r["p_low"] + r["p_high"] - 1) < 1e-9 and r["rate"] >= 0
        if r["doc_id"] is not None and r["doc_id"] < 400:
            assert max(("toxic", "low", "high"), key=lambda d: r[f"p_{d}"]) == ["toxic", "low", "high"][min(r["doc_id"] % 5, 2)]
    prior = [r for r in rows if r["doc_id"] in (900, 901)]
    assert prior[0]["p_high"] == prior[1]["p_high"] and prior[0]["n_tokens"] == 0


def test_classifier_counts_match_brute_force(spark):
    docs, labels = tables(spark)
    model = M.fit(docs, labels, Scratch(spark, "mixing-test"))
    weights = {r["bucket"]: (r["l0"], r["l1"], r["l2"]) for r in model.table.collect()}
    words = spark.createDataFrame([("scum",), ("|",), ("plain",)], "w string").select("w", M._bucket(F.col("w")).alias("b")).collect()
    bucket = {r["w"]: r["b"] for r in words}
    assert weights[bucket["scum"]][0] > max(weights[bucket["scum"]][1:]) and weights[bucket["|"]][1] > weights[bucket["|"]][2]
    assert bucket["plain"] not in weights
    odd = [i for i, _, _ in ROWS if i % 2]
    n = [sum(min(i % 5, 2) == k for i in odd) for k in range(3)]
    n[1] += 0
    has = [min(0.99, ((n[k] if k == 0 else 0) + 0.5) / (n[k] + 1)) for k in range(3)]
    assert np.allclose(weights[bucket["scum"]][0], np.log(has[0] / (1 - has[0])), atol=0.2)


def test_no_labels_and_empty_table(spark):
    docs, labels = tables(spark)
    out = M.mix(docs, labels.limit(0), {"toxic": 0.2, "low": 0.3, "high": 0.5}).collect()
    assert {(r["p_toxic"], r["p_low"]) for r in out} == {(0.333, 0.333)}
    assert M.mix(docs.limit(0), labels, {"toxic": 0.0, "low": 0.3, "high": 0.7}).count() == 0


def test_no_python_in_the_plan(spark):
    docs, labels = tables(spark)
    scratch = Scratch(spark, "mixing-test")
    plan = M.posteriors(docs, M.fit(docs, labels, scratch), "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_keeps_every_document_and_its_posteriors_fit_the_labels(spark):
    """op4 over the table: posteriors that sum to one, found domains that agree with the labels, tokens near the targets."""
    sf = "/root/testdata/sf0.01"
    rows = M.op4_mixing(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all(r["n_tokens"] == len([w for w in __import__("re").split(r"[ \t\n\x0b\f\r]+", (texts[r["doc_id"]] or "").lower()) if w]) for r in rows)
    assert all(abs(r["p_toxic"] + r["p_low"] + r["p_high"] - 1) < 1e-9 for r in rows)
    labels = {r["doc_id"]: r["domain"] for r in M.label_domains(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    named = [(labels[r["doc_id"]], max(("toxic", "low", "high"), key=lambda d: r[f"p_{d}"])) for r in rows if labels.get(r["doc_id"])]
    assert sum(a == b for a, b in named) >= 0.85 * len(named)
    total = sum(r["n_tokens"] for r in rows)
    for d, share in (("toxic", 0.0), ("low", 0.1), ("high", 0.9)):
        assert abs(sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) / total - share) < 0.02
