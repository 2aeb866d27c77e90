"""Mixing sources to target weights by soft membership, in DataFrame functions only.

A naive Bayes classifier, trained on a labelled table, gives every document a
posterior over the domains. Its features are the distinct words of a text (and
whether a word repeats at once), hashed to ``BUCKETS``; only buckets that tell some domain from
the rest by ``Z_SCORE`` standard deviations count, whether a text holds them or not, so
the broadcast table is small. A text without words keeps the prior. Posteriors are in thousandths, rounded down but for
the last domain: each is off by less than 0.001 (the last by less than 0.001 a domain), and so are expected token shares.

Rates minimise the squared distance between expected and target domain tokens,

    1/2 sum_d (sum_i rate_i tokens_i p_id - target_d)^2,  rate_i >= 0,

by projected gradient steps from rate 1, scaled by the domains' Gram matrix over the free
rates. The step on a document depends on its posterior alone: documents with equal
posteriors are summed once into one point, and every step is an aggregation over the
points that returns a few numbers per domain.

Defined cases: null texts are empty: no tokens and the prior; labelled rows with a
null id or domain, or a domain not asked for, teach nothing; of several labels of
an id the first in the order of domains counts; without labels the prior is even;
repeated rows are documents of their own; a text of any length is one document; an empty table gives no rows and rates of 1; other columns pass through unless they have an output's name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch

BUCKETS = 1 << 16
SAMPLE = 20_000              # labelled documents that one domain teaches with, about; a bounded sample
Z_SCORE = 5.0
ENOUGH = 1e-4                # slope, over the tokens, at which the fit ends
STEPS = 60                   # aggregations after which a fit that is not there yet ends and says so
DOCUMENT = "\u0000document"    # counts documents among the words; no word holds a NUL
POSTERIOR = "__domain_posterior"
DOMAINS = ("toxic", "low", "high")


def _bucket(word):
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _words(text: str):
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")


def _features(name: str):
    """Distinct words of an array column, and a mark where a word follows itself. The
    array has to be a column of its own: inside the lambda an expression would run again for each word."""
    words = F.col(name)
    again = F.exists(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda k: F.coalesce(F.get(words, k) == F.get(words, k - 1), F.lit(False)))
    return F.array_distinct(F.when(again, F.concat(words, F.array(F.lit("\u0000again")))).otherwise(words))


@dataclass
class Classifier:
    """Per informative bucket (columns bucket, l0, l1, ..) the log odds that a document of
    each domain holds it; the log prior; the log probability of holding none of them."""

    table: DataFrame
    prior: list[float]
    missing: list[float]


def fit(docs: DataFrame, labelled: DataFrame, scratch: Scratch, domains: tuple[str, ...] = DOMAINS, id_col: str = "doc_id", text: str = "text",
        domain: str = "domain", sample: int = SAMPLE) -> Classifier:
    """Counts, per domain, the sampled documents that hold each bucket."""
    order = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col(domain))
    known = labelled.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), order.alias("d")).where("d > 0")
    known = known.groupBy("__id").agg((F.min("d") - 1).cast("int").alias("d"))
    sizes = {r["d"]: r["count"] for r in known.groupBy("d").count().collect()}
    total = sum(sizes.values())
    prior = [(sizes.get(k, 0) + 1) / (total + len(domains)) for k in range(len(domains))]
    share = F.lit(0)
    for k, n in sizes.items():
        share = F.when(F.col("d") == k, F.lit(int(1_000_000 * min(1.0, sample / n)))).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < share)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    marked = F.concat(_features("__w"), F.array(F.lit(DOCUMENT)))
    words = rows.select("d", _words("__text").alias("__w")).select("d", F.explode(marked).alias("w"))
    bucket = F.when(F.col("w") == DOCUMENT, -1).otherwise(_bucket(F.col("w")))
    every = range(len(domains))
    counts = scratch.write(words.groupBy(bucket.alias("bucket")).agg(*[F.count_if(F.col("d") == k).cast("double").alias(f"n{k}") for k in every]))
    docs_of = counts.where("bucket = -1").first() or [0, *[0.0] * len(domains)]
    size = [float(x) for x in docs_of[1:]]
    n = sum((F.col(f"n{k}") for k in every), F.lit(0.0))

    def tells(k):
        s = min(max(size[k] / max(sum(size), 1.0), 1e-9), 1 - 1e-9)
        return F.abs(F.col(f"n{k}") - n * s) / F.sqrt(n * (s * (1 - s)) + 1.0)

    has = [F.least(F.lit(0.99), (F.col(f"n{k}") + 0.5) / F.lit(size[k] + 1.0)) for k in every]
    table = counts.where(F.col("bucket") >= 0).where(F.greatest(*[tells(k) for k in every]) > Z_SCORE)
    table = scratch.write(table.select("bucket", *[F.log(q / (1 - q)).alias(f"l{k}") for k, q in enumerate(has)], *[F.log(1 - q).alias(f"m{k}") for k, q in enumerate(has)]))
    missing = table.agg(*[F.coalesce(F.sum(f"m{k}"), F.lit(0.0)) for k in every]).first()
    return Classifier(table.select("bucket", *[f"l{k}" for k in every]), [math.log(p) for p in prior], list(missing))


def posteriors(docs: DataFrame, classifier: Classifier, text: str = "text", out: str = POSTERIOR, tokens: str = "n_tokens") -> DataFrame:
    """Columns of ``docs`` but the text, with the number of words and the posterior in thousandths (array of int)."""
    kept = [c for c in docs.columns if c not in (text, out, tokens)]
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*kept).alias("__kept"), _words(text).alias("__w"))
    rows = rows.select("__row", "__kept", F.size("__w").cast("long").alias("__n"), F.explode_outer(_features("__w")).alias("__w")).withColumn("bucket", _bucket(F.col("__w")))
    rows = rows.join(F.broadcast(classifier.table), "bucket", "left")
    # log evidence per domain; the marks of a row stay together in its partition, so the sums are made before the shuffle
    sums = rows.groupBy("__row").agg(F.first("__kept").alias("__kept"), F.first("__n").alias("__n"), *[F.coalesce(F.sum(f"l{k}"), F.lit(0.0)).alias(f"s{k}") for k in range(len(classifier.prior))])
    logit = [F.when(F.col("__n") == 0, F.lit(p)).otherwise(F.col(f"s{k}") + F.lit(p + m)) for k, (p, m) in enumerate(zip(classifier.prior, classifier.missing))]
    top = F.greatest(*logit)
    power = [F.exp(x - top) for x in logit]
    whole = sum(power, F.lit(0.0))
    first = [F.floor(p / whole * 1000).cast("int") for p in power[:-1]]
    last = F.lit(1000) - sum(first, F.lit(0))
    return sums.select("__kept.*", F.col("__n").alias(tokens), F.array(*first, last).alias(out))


class Rates:
    """Steps so far; ``of`` turns a posterior into its rate by repeating them from rate 1. At the end of a fit: ``residual``, expected
    less target tokens of each domain over all tokens; ``slope``, that of the objective along the free rates; ``converged``, whether it is small enough."""

    def __init__(self):
        self.steps: list[list[float]] = []
        self.residual: list[float] = []
        self.slope, self.converged = 0.0, True

    def of(self, p):
        if not self.steps:
            return F.lit(1.0)
        steps = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in self.steps])
        return F.aggregate(steps, F.lit(1.0), lambda r, step: F.greatest(F.lit(0.0), r - _dot(p, step, len(self.steps[0]))))


def _dot(p, step, n: int):
    return sum((F.element_at(p, d + 1) / 1000 * F.element_at(step, d + 1) for d in range(n)), F.lit(0.0))


def _scaled(gram: list[list[float]], miss: list[float]) -> list[float]:
    """Solves (gram + a small ridge) x = miss, by elimination; one row per domain."""
    n = len(miss)
    ridge = 1e-4 * max(sum(gram[k][k] for k in range(n)), 1e-9)
    rows = [[gram[a][b] + ridge * (a == b) for b in range(n)] + [miss[a]] for a in range(n)]
    for k in range(n):
        best = max(range(k, n), key=lambda r: abs(rows[r][k]))
        rows[k], rows[best] = rows[best], rows[k]
        for r in range(n):
            if r != k:
                share = rows[r][k] / rows[k][k]
                rows[r] = [x - share * y for x, y in zip(rows[r], rows[k])]
    return [rows[k][n] / rows[k][k] for k in range(n)]


def solve(points: DataFrame, targets: list[float], p: str = "p", tokens: str = "tokens", steps: int = STEPS, enough: float = ENOUGH) -> Rates:
    """Projected gradient over points (posterior, tokens); targets in tokens.

    A step scaled by the Gram matrix of the free rates is tried first, then a quarter
    of it; if neither lowers the objective enough, the plain gradient step is taken, which always lowers
    it. It ends when the gradient along the free rates, over the tokens, is below ``enough``, or after ``steps``
    aggregations; the result says which (``converged``), and by how much the targets are missed. Targets far out of the posteriors'
    reach are approached slowly."""
    n = len(targets)
    cells = [(a, b) for a in range(n) for b in range(a, n)]
    share = [F.col("p")[d] / 1000 for d in range(n)]

    def at(rates: Rates) -> DataFrame:
        return points.select(F.col(p).alias("p"), F.col(tokens).alias("t"), rates.of(F.col(p)).alias("r"))

    def miss_of(rates: Rates) -> list[float]:
        row = at(rates).agg(*[F.coalesce(F.sum(F.col("t") * F.col("r") * s), F.lit(0.0)) for s in share]).first()
        return [(x - goal) / total for x, goal in zip(row, targets)]

    def gram_of(rates: Rates, miss: list[float]) -> list[list[float]]:
        pull = sum((s * F.lit(float(m)) for s, m in zip(share, miss)), F.lit(0.0))
        free = F.when((F.col("r") > 0) | (pull < 0), F.col("t")).otherwise(0)
        row = at(rates).agg(*[F.coalesce(F.sum(free * share[a] * share[b]), F.lit(0.0)) for a, b in cells]).first()
        gram = [[0.0] * n for _ in range(n)]
        for (a, b), value in zip(cells, row):
            gram[a][b] = gram[b][a] = float(value) / total
        return gram

    rates = Rates()
    rates.residual = [0.0] * n
    total = float(points.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0])
    if total <= 0:
        return rates
    miss, done, top = miss_of(rates), 2, None
    while True:
        gram = gram_of(rates, miss)
        top = top or max(sum(abs(x) for x in row) for row in gram)      # all rates are free at first: bounds the largest eigenvalue
        slope = sum(miss[a] * gram[a][b] * miss[b] for a in range(n) for b in range(n))
        done += 1
        rates.slope, rates.residual = max(slope, 0.0) ** 0.5, miss
        rates.converged = rates.slope < enough
        if rates.converged or done >= steps:
            return rates
        size, step = sum(x * x for x in miss), _scaled(gram, miss)
        for scale in (1.0, 0.25, None):
            rates.steps.append([x * scale for x in step] if scale else [x / top for x in miss])
            found = miss_of(rates)
            done += 1
            if scale is None or sum(x * x for x in found) <= size - slope / (2 * top):
                break
            rates.steps.pop()
        miss = found


def mix(docs: DataFrame, labelled: DataFrame, target: dict[str, float], relative: bool = False, id_col: str = "doc_id", text: str = "text",
        domain: str = "domain", report: dict | None = None) -> DataFrame:
    """Columns of ``docs`` but the text, with n_tokens, p_<domain> and rate.

    ``target``: share of the corpus's tokens per domain; if ``relative``, a multiple of the domain's own expected tokens. ``report``, if given, takes the
    fit's residual (per domain, over all tokens), slope and whether it converged."""
    scratch = Scratch(docs.sparkSession, "mixing")
    domains = tuple(target)
    classifier = fit(docs, labelled, scratch, domains, id_col, text, domain)
    names = [f"p_{d}" for d in domains]
    plain = docs.drop(*names, "n_tokens", "rate")
    placed = scratch.write(posteriors(plain, classifier, text))
    points = scratch.write(placed.groupBy(F.col(POSTERIOR).alias("p")).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")))
    own = points.agg(*[F.coalesce(F.sum(F.col("tokens") * F.col("p")[k] / 1000), F.lit(0.0)) for k in range(len(domains))]).first()
    goal = [x * w for x, w in zip(own, target.values())] if relative else [sum(own) * w for w in target.values()]
    rates = solve(points, goal)
    if report is not None:
        report |= {"residual": dict(zip(domains, rates.residual)), "slope": rates.slope, "converged": rates.converged}
    # one rate per point, then per document
    point_rates = points.select(F.col("p").alias("__q"), rates.of(F.col("p")).alias("rate"))
    out = placed.join(point_rates, F.col(POSTERIOR) == F.col("__q"))
    return scratch.finish(out.select(*[c for c in placed.columns if c != POSTERIOR], *[(F.col(POSTERIOR)[k] / 1000).alias(c) for k, c in enumerate(names)], "rate"))


def label_domains(labels: DataFrame) -> DataFrame:
    """The labels table's rows as domains."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("domain"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labelled = label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mix(docs, labelled, {"toxic": 0.0, "low": 0.1, "high": 0.9})
