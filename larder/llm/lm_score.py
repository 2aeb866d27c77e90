"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are whitespace words with A-Z lower-cased, then one end per text. The
``CLASSES * MEMBERS`` most frequent tokens form classes by frequency; all others
share one more class, inside which they keep their smoothed unigram share. So

    P(w | h) = P(class(w) | h) * P(w | class(w), h)

Both factors are softmaxes over the sum of weight rows named by features of the
history h: the token before (bigram), the one before that (a skip), and both
(trigram, hashed). Rows of the second factor are hashed from feature and class.

Training makes ``ROUNDS`` rounds over disjoint parts of all training texts: tasks
add up the gradient (observed minus expected counts of every feature) under the
broadcast weights, the gradients are summed over tasks in two steps, and each
weight moves by its gradient over its expected count, damped. The weights have a
fixed size; unigram counts of all tokens grow with the corpus and stay distributed.

Scoring handles tokens among the ``HEAD`` most frequent in the pass over the texts;
the rest meet their counts in a join. Tokens are named by 64-bit hashes; two of V
tokens share one with a chance of about V**2 / 2**60.

Defined cases: a null text is empty and has its end only; with no training tokens
the counts are zero and scores follow the formula; rows equal in id and text count and score alike; a null id counts as
held out; an empty table gives no rows; a text of any length is read whole; of equally frequent tokens those
of smaller hash are taken first; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import words as W
from larder.llm.scratch import Scratch, crc_mod, row_key

CLASSES, MEMBERS = 32, 64
HEAD = 1 << 18               # frequent tokens broadcast with their counts: 4 MB
PAIR_ROWS = 1 << 12          # hashed trigram rows of the class factor
WORD_ROWS = 1 << 14          # hashed rows of the word factor
ROUNDS = 3
ADD = 0.1                    # unigram smoothing
PRIOR = 4.0                  # damping of a weight's step, in expected counts
FEATURES = 3
BLOCKS, SALTS = 64, 32       # gradients are summed per block of rows, over salts first
END = np.uint64(0x7E57E4D0F7E47001)
SHORT = CLASSES * MEMBERS
RARE, START = SHORT, SHORT + 1
CONTEXTS = SHORT + 2
CLASS_ROWS = 2 * CONTEXTS + PAIR_ROWS
SEPARATORS = W.separator_table(W.SPACE)
HOLD = 1 << 21
TASKS = 12                   # at least so many tasks learn, else two per core: each returns a gradient of the model's size
STEP = 1 << 15               # tokens whose probabilities are held at once


def _tokens(batch_column):
    """Piece by piece: first text, token hashes with ends, first token of each text."""
    data, offs, _ = W.text_buffers(batch_column)
    for lo, hi in W.pieces(offs):
        w = W.split_words(data, offs[lo:hi + 1], SEPARATORS, True)
        first = w.first + np.arange(hi - lo + 1)
        code = np.full(first[-1], END, dtype=np.uint64)
        code[np.arange(len(w.code)) + w.text_of()] = w.code
        yield lo, code, first


def count_tokens(texts: DataFrame) -> DataFrame:
    """(code, n) over all texts; tasks add up what they hold before the shuffle."""

    def count(batches):
        held, size = [], 0

        def merged():
            code, of = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return code, np.bincount(of, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            for _, code, _ in _tokens(batch.column(0)):
                held.append(np.unique(code, return_counts=True))
                size += len(held[-1][0])
                if size > HOLD:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > HOLD // 2:
                        yield pa.record_batch([pa.array(W.signed(held[0][0])), pa.array(held[0][1])], names=["code", "n"])
                        held, size = [], 0
        if held:
            code, n = merged()
            yield pa.record_batch([pa.array(W.signed(code)), pa.array(n)], names=["code", "n"])

    return texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The head: token hashes (sorted), counts and short ids; and totals of the corpus."""

    code: np.ndarray
    n: np.ndarray
    short: np.ndarray
    tokens: int
    types: int
    short_n: np.ndarray           # counts by short id, 0 where there is none

    def __post_init__(self):
        self.slot = np.searchsorted(self.code, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44)) if len(self.code) else np.zeros((1 << 20) + 1, np.int64)
        self.slot[-1] = len(self.code)
        self.longest = int(np.diff(self.slot).max())

    def place(self, code: np.ndarray) -> np.ndarray:
        """Index in the head, -1 outside."""
        out = np.full(len(code), -1, dtype=np.int64)
        top = (code >> np.uint64(44)).astype(np.int64)
        at, end = self.slot[top], self.slot[top + 1]
        for _ in range(self.longest):
            live = np.flatnonzero(at < end)
            hit = self.code[at[live]] == code[live]
            out[live[hit]] = at[live[hit]]
            at = at + 1
        return out

    @property
    def rare_total(self) -> float:
        rare_types = self.types - int((self.short_n > 0).sum())
        return float(self.tokens - self.short_n.sum() + ADD * (rare_types + 1))


def head_of(counts: DataFrame) -> Vocabulary:
    """At most HEAD of the most frequent tokens; of equally frequent ones those of smaller hash (by its upper 16 bits)
    come first, so that many tokens of one count do not empty the head. Small histograms find the bounds."""
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    def fitting(rows: DataFrame, by, room: int, descending: bool):
        """The value of ``by`` at which the rows up to it no longer fit, None if all do; the room left before it."""
        found = {r["k"]: r["count"] for r in rows.groupBy(by.alias("k")).count().collect()}
        for k in sorted(found, reverse=descending):
            if found[k] > room:
                return k, room
            room -= found[k]
        return None, room

    level, upper = F.floor(F.log2("n") * 16).cast("int"), F.shiftrightunsigned("code", 48)
    full, room = fitting(counts, level, HEAD, True)
    taken = F.lit(True)
    if full is not None:                 # a level that fits in part is taken by counts, one of its counts by hashes
        last, room = fitting(counts.where(level == full), F.col("n"), room, True)
        bound, _ = fitting(counts.where(F.col("n") == last), upper, room, False)
        taken = (level > full) | ((level == full) & (F.col("n") > last)) | ((F.col("n") == last) & (upper < bound))
    table = counts.where(taken).toArrow()
    code, n = table.column("code").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(code)
    code, n = code[order], n[order].astype(np.int64)
    best = np.lexsort((code, -n))[:SHORT]
    short = np.full(len(code), RARE, dtype=np.int32)
    short[best] = np.arange(len(best))
    short_n = np.zeros(SHORT, dtype=np.int64)
    short_n[:len(best)] = n[best]
    return Vocabulary(code, n, short, int(tokens), int(types), short_n)


@dataclass
class Model:
    class_bias: np.ndarray        # CLASSES + 1
    word_bias: np.ndarray         # CLASSES x MEMBERS
    class_rows: np.ndarray        # CLASS_ROWS x (CLASSES + 1)
    word_rows: np.ndarray         # WORD_ROWS x MEMBERS


def start(vocabulary: Vocabulary) -> Model:
    """The unigram model: zero weights, biases from the counts."""
    n = vocabulary.short_n.reshape(CLASSES, MEMBERS).astype(float)
    rare = max(vocabulary.rare_total, ADD)
    mass = np.append(n.sum(axis=1), rare)
    with np.errstate(divide="ignore", invalid="ignore"):
        words = np.where(n > 0, np.log(n) - np.log(n.sum(axis=1, keepdims=True)), -np.inf)
        classes = np.log(mass / mass.sum())
    return Model(classes, words, np.zeros((CLASS_ROWS, CLASSES + 1), np.float32), np.zeros((WORD_ROWS, MEMBERS), np.float32))


def _hash(*parts) -> np.ndarray:
    h = np.zeros(1, dtype=np.uint64)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ (h >> np.uint64(29))
    return h


def _features(short: np.ndarray, first: np.ndarray):
    """Rows of the class factor (tokens x 3), and a function for those of the word factor."""
    a, b = np.empty_like(short), np.empty_like(short)
    a[1:], b[2:] = short[:-1], short[:-2]
    heads = first[:-1]
    a[heads] = START
    b[heads] = START
    after = heads + 1
    b[after[after < first[1:]]] = START
    rows = np.stack([a, CONTEXTS + b, 2 * CONTEXTS + (_hash(a, b, 7) >> np.uint64(40)) % np.uint64(PAIR_ROWS)], axis=1).astype(np.int64)

    def word_rows(at, group):
        mine = np.uint64(WORD_ROWS)
        return np.stack([(_hash(k, x, y, group) >> np.uint64(40)) % mine for k, x, y in ((1, a[at], 0), (2, b[at], 0), (3, a[at], b[at] + 1))], axis=1).astype(np.int64)

    return rows, word_rows


class _Scorer:
    """Probabilities from exponentials of the weights: products of rows, no exponential per token."""

    def __init__(self, model: Model):
        self.class_base, self.word_base = np.exp(model.class_bias).astype(np.float32), np.exp(model.word_bias).astype(np.float32)
        self.class_rows, self.word_rows = np.exp(model.class_rows), np.exp(model.word_rows)

    def classes(self, rows):
        p = self.class_rows[rows[:, 0]]
        p *= self.class_rows[rows[:, 1]]
        p *= self.class_rows[rows[:, 2]]
        p *= self.class_base
        p /= p.sum(axis=1, keepdims=True)
        return p

    def words(self, rows, group):
        p = self.word_rows[rows[:, 0]]
        p *= self.word_rows[rows[:, 1]]
        p *= self.word_rows[rows[:, 2]]
        p *= self.word_base[group]
        p /= p.sum(axis=1, keepdims=True)
        return p


def _add(total: np.ndarray, seen: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """total[rows] += gradient, by sorting the rows; seen counts them."""
    for k in range(rows.shape[1]):
        order = np.argsort(rows[:, k], kind="stable")
        own = rows[order, k]
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        total[own[begin]] += np.add.reduceat(gradient[order], begin, axis=0)
        seen[own[begin]] += np.diff(np.append(begin, len(own)))


def _gradient(texts: DataFrame, vocabulary, model, salt: int) -> tuple[np.ndarray, ...]:
    """Observed minus expected counts per weight, and how often each row was active."""
    shapes = [(CLASS_ROWS, CLASSES + 1), (WORD_ROWS, MEMBERS)]
    per_block = [-(-rows // BLOCKS) for rows, _ in shapes]

    def blob(parts):
        import zstandard
        return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(p, dtype=np.float32).tobytes() for p in parts))

    def unblob(raw):
        import zstandard
        flat, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.float32), 0, []
        for n, (_, width) in zip(per_block, shapes):
            out += [flat[at:at + n * width].reshape(n, width), flat[at + n * width:at + n * width + n]]
            at += n * width + n
        return out

    def learn(batches):
        known, scorer = vocabulary.value, _Scorer(model.value)
        total = [np.zeros((per_block[k] * BLOCKS, shapes[k][1]), np.float32) for k in (0, 1)]
        seen = [np.zeros(per_block[k] * BLOCKS, np.float32) for k in (0, 1)]
        any_token = False
        for batch in batches:
            for _, code, first in _tokens(batch.column(0)):
                any_token = True
                at = known.place(code)
                short = np.where(at >= 0, known.short[at], RARE)
                rows, word_rows = _features(short, first)
                for lo in range(0, len(short), STEP):
                    mine = short[lo:lo + STEP]
                    group = mine // MEMBERS
                    p = scorer.classes(rows[lo:lo + STEP])
                    p *= -1
                    p[np.arange(len(mine)), group] += 1
                    _add(total[0], seen[0], rows[lo:lo + STEP], p)
                    place = np.flatnonzero(mine < SHORT)
                    if len(place):
                        own = word_rows(lo + place, group[place])
                        p = scorer.words(own, group[place])
                        p *= -1
                        p[np.arange(len(place)), mine[place] % MEMBERS] += 1
                        _add(total[1], seen[1], own, p)
        if any_token:
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            for k in range(BLOCKS):
                cut = [slice(k * n, (k + 1) * n) for n in per_block]
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([(task + salt) % SALTS], pa.int32()),
                                       pa.array([blob([total[0][cut[0]], seen[0][cut[0]], total[1][cut[1]], seen[1][cut[1]]])], pa.binary())], names=["block", "salt", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = None
        for raw in table["sums"]:
            parts = unblob(raw.as_py())
            total = [p.copy() for p in parts] if total is None else [t + p for t, p in zip(total, parts)]
        return pa.table({"block": table["block"][:1], "salt": pa.array([0], pa.int32()), "sums": pa.array([blob(total)], pa.binary())})

    schema = "block int, salt int, sums binary"
    parts = texts.mapInArrow(learn, schema)
    summed = parts.groupBy("block", "salt").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema).collect()
    out = [np.zeros((n * BLOCKS, width), np.float32) for n, (_, width) in zip(per_block, shapes)]
    active = [np.zeros(n * BLOCKS, np.float32) for n in per_block]
    for r in summed:
        got = unblob(bytes(r["sums"]))
        for k, n in enumerate(per_block):
            out[k][r["block"] * n:(r["block"] + 1) * n] = got[2 * k]
            active[k][r["block"] * n:(r["block"] + 1) * n] = got[2 * k + 1]
    return out[0][:CLASS_ROWS], active[0][:CLASS_ROWS], out[1][:WORD_ROWS], active[1][:WORD_ROWS]


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Gradient rounds over disjoint parts of the texts (column text)."""
    sc = texts.sparkSession.sparkContext
    model, shared = start(vocabulary), sc.broadcast(vocabulary)
    class_share = np.exp(model.class_bias)
    # a word row is shared by classes; a member's mean share stands for its expected one
    member_share = np.exp(np.where(np.isfinite(model.word_bias), model.word_bias, -20)).mean(axis=0)
    for k in range(rounds):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).coalesce(max(TASKS, 2 * sc.defaultParallelism))
        grad, active, word_grad, word_active = _gradient(part, shared, sc.broadcast(model), k)
        for weights, g, n, share in ((model.class_rows, grad, active, class_share), (model.word_rows, word_grad, word_active, member_share)):
            ratio = g / (n[:, None] * share[None, :] + PRIOR)
            weights += (np.log1p(np.maximum(ratio, -0.9)) / FEATURES).astype(np.float32)
    return model


def score_texts(docs: DataFrame, keep: list[str], counts: DataFrame, vocabulary: Vocabulary, model: Model, scratch: Scratch,
                id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep`` columns with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    sc = docs.sparkSession.sparkContext
    known_, model_ = sc.broadcast(vocabulary), sc.broadcast(model)
    rows = docs.select(*keep, row_key(id_col, text).alias("__key"), F.col(text).alias("__text"))
    at_text = len(keep) + 1
    schema = T.StructType([docs.select(*keep).schema[c] for c in keep] + [T.StructField("__key", T.LongType()), T.StructField("n_tokens", T.LongType()),
                          T.StructField("__known", T.LongType()), T.StructField("__head", T.DoubleType()), T.StructField("__model", T.DoubleType()),
                          T.StructField("__tail", T.ArrayType(T.LongType()))])
    rare_log = np.log10(max(vocabulary.rare_total, ADD))

    def run(batches):
        known, scorer = known_.value, _Scorer(model_.value)
        log_n = np.log10(known.n + ADD)
        for batch in batches:
            for lo, code, first in _tokens(batch.column(at_text)):
                at = known.place(code)
                inside = at >= 0
                short = np.where(inside, known.short[at] if len(known.short) else RARE, RARE)
                head = np.where(inside, log_n[at] if len(log_n) else 0.0, 0.0)
                rows, word_rows = _features(short, first)
                # a rare token in the head takes its unigram share of the rare class; one of the tail adds its count's part later
                part = np.where(short == RARE, head - rare_log, 0.0)
                for k in range(0, len(short), STEP):
                    mine = short[k:k + STEP]
                    group = mine // MEMBERS
                    p = scorer.classes(rows[k:k + STEP])[np.arange(len(mine)), group]
                    part[k:k + STEP] += np.log10(np.maximum(p, 1e-30))
                    place = np.flatnonzero(mine < SHORT)
                    if len(place):
                        p = scorer.words(word_rows(k + place, group[place]), group[place])[np.arange(len(place)), mine[place] % MEMBERS]
                        part[k + place] += np.log10(np.maximum(p, 1e-30))
                begin = first[:-1]
                tail = code[~inside]
                bound = np.concatenate([[0], np.cumsum(~inside)])[first]
                count = len(begin)
                yield pa.record_batch([*[c.slice(lo, count) for c in batch.columns[:at_text]], pa.array(np.diff(first)), pa.array(np.add.reduceat(inside.astype(np.int64), begin)),
                                       pa.array(np.add.reduceat(head, begin)), pa.array(np.add.reduceat(part, begin)),
                                       pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(W.signed(tail)))], names=schema.names)

    scored = scratch.write(rows.mapInArrow(run, schema))
    tail = scored.select("__key", F.explode("__tail").alias("code"))
    tail = tail.join(counts, "code", "left").groupBy("__key").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + ADD)).alias("logs"), F.count("n").alias("known"))
    same = scored.groupBy("__key").agg(F.count("*").alias("rows"))       # rows equal in id and text added up alike
    tail = tail.join(same, "__key").select(F.col("__key").alias("k"), (F.col("logs") / F.col("rows")).alias("logs"), (F.col("known") / F.col("rows")).cast("long").alias("known"))
    total = np.log10(vocabulary.tokens + ADD * (vocabulary.types + 1))
    logs = F.coalesce("logs", F.lit(0.0))
    return scratch.finish(scored.join(tail, F.col("__key") == F.col("k"), "left").select(
        *keep, "n_tokens", (F.col("__known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("__head") + logs - F.col("n_tokens") * F.lit(float(total))).alias("base_score"), (F.col("__model") + logs).alias("score")))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lm")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (crc_mod("doc_id", 10) == 0).alias("held_out"))
    texts = docs.where("NOT held_out").select("text")
    counts = scratch.write(count_tokens(texts))
    vocabulary = head_of(counts)
    return score_texts(docs, ["doc_id", "held_out"], counts, vocabulary, train(texts, vocabulary), scratch)
