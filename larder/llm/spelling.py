"""Spelling variant grouping over an index of variable-length grams.

Gram dictionary: the grams of all words, between a start and an end mark, are counted by length,
from ``SHORTEST`` on; a gram of more than ``FREQUENT`` occurrences is frequent and
is extended, all others are not extended further (their extensions are never counted). So the
dictionary is pruned by frequency, and a gram that ends its branch occurs ``FREQUENT`` times at most.

Decomposition: at every place of a word stands the shortest gram that is not frequent,
if the word is long enough for one. Which gram stands at a place depends on the characters
of that gram alone, so one edit affects exactly the grams that it lies in.

Affected grams: take a word's gram that ends first and the one that starts
last. All that stands left of an edit ends up in both words, so a gram that ends before
the edit is the first to end in both; the same holds at the right. Where the first gram ends before
the last one starts, no edit can affect both: the word's bound is one
spared gram, and all its near words are in the list of one of the two. A word with such a
bound merges its two lists; lists hold ``FREQUENT`` words at most, by the pruning. Words without one
(too short for the frequency of their parts) find words with a bound in the lists of those,
and each other by the strings that one deletion makes of them. Every pair found is
verified by its edit distance. A task needs memory for the longest word, about 100 bytes a code point.

Defined cases: null and empty texts have no words; a null id counts as an empty one; rows that repeat
count as often as they occur; words may be of any length; of near words with equal counts the
smallest in code-point order is the form; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import words as W
from larder.llm.scratch import Scratch

LEAST_CHARS = 7
LEAST_COUNT = 2
TIMES = 10                   # a form occurs so many times as often as its variant
SHORTEST, LONGEST = 2, 8     # code points of a gram, marks included
FREQUENT = 512               # occurrences up to which a gram is not extended
GRAMS = 1 << 21              # bound of the frequent grams of one length (16 MB); beyond 10^9 places FREQUENT grows
SLIPS = 31                   # one run in so many loses a code point
PENDING = 1 << 18            # distinct words a task counts before it hands them on
START, END = "\x02", "\x03"

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = {c: c + 32 for c in range(65, 91)}
_U = np.uint64


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, slips: int = SLIPS) -> DataFrame:
    """(word, n): the words of all texts, A-Z in lower case. A crc32 of id and word
    decides which occurrences lose a code point (``slips``; 0: none)."""

    def count(batches):
        seen = Counter()
        for batch in batches:
            for doc, value in zip(batch.column(0), batch.column(1)):
                content = value.as_py()
                if not content:
                    continue
                lead = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for run, n in Counter(RUN.findall(content.translate(FOLD))).items():
                    if len(run) < least_chars:
                        continue
                    h = zlib.crc32(run.encode(), lead)
                    if slips and h % slips == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least_chars:
                            continue
                    seen[run] += n
                if len(seen) > PENDING:
                    yield pa.record_batch([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
                    seen.clear()
        yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string"), F.col(text))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Marked:
    """Code points of a batch of words, each between marks, one after another."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) + 2 for w in words], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        points = np.frombuffer("".join(f"{START}{w}{END}" for w in words).encode("utf-32-le"), np.uint32).astype(_U)
        self.code = W.mix(points * _U(0x9E3779B97F4A7C15) + _U(0x2545F491))
        self.room = np.repeat(self.first[1:], self.size) - np.arange(len(points))

    def grams(self, length: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the places ``among`` with a gram of this length, and the grams' hashes."""
        at = among[self.room[among] >= length]
        return at, W.sequence_codes(self.code, at, length)


def _batches(column):
    """(first row, words) of parts of a column, of about a megabyte each."""
    _, offsets, _ = W.text_buffers(column)
    for lo, hi in W.pieces(offsets, 1 << 20):
        yield lo, column.slice(lo, hi - lo).to_pylist()


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def gram_dictionary(words: DataFrame, word: str = "word", frequent: int = FREQUENT, shortest: int = SHORTEST, longest: int = LONGEST) -> list[np.ndarray]:
    """Hashes of the frequent grams, sorted, for each length from ``shortest`` on."""
    spark = words.sparkSession
    places = words.agg(F.sum(F.char_length(word).cast("long") + 2)).first()[0] or 0
    frequent = max(frequent, -(-places // GRAMS))
    known: list[np.ndarray] = []
    for length in range(shortest, longest + 1):
        shared = spark.sparkContext.broadcast(known)

        def count(batches, length=length, shared=shared):
            for batch in batches:
                for _, some in _batches(batch.column(0)):
                    marked = _Marked(some)
                    at = np.arange(len(marked.code))
                    for shorter, hot in enumerate(shared.value, shortest):       # only frequent grams are extended
                        at, code = marked.grams(shorter, at)
                        at = at[_member(hot, code)]
                    gram, n = np.unique(marked.grams(length, at)[1], return_counts=True)
                    yield pa.record_batch([pa.array(W.signed(gram)), pa.array(n.astype(np.int64))], names=["gram", "n"])

        counted = words.select(word).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        hot = np.sort(counted.where(F.col("n") > frequent).select("gram").toArrow().column(0).to_numpy().astype(np.int64).view(_U))
        if not len(hot):
            break
        known.append(hot)
    return known


def border_grams(words: DataFrame, dictionary: list[np.ndarray], word: str = "word", n: str = "n", shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(key, word, n, bound): for each word the gram that ends first with its place, and the
    one that starts last with its place from the end; a key is null where there is none. ``bound`` is the number of
    the two that every edit spares."""
    shared = words.sparkSession.sparkContext.broadcast(dictionary)

    def cut(batches):
        for batch in batches:
            for lo, some in _batches(batch.column(0)):
                marked = _Marked(some)
                size, total = marked.size, len(marked.code)
                width, code_at = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=_U)
                at = np.arange(total)
                for length in range(shortest, longest + 1):
                    at, code = marked.grams(length, at)
                    hot = _member(shared.value[length - shortest], code) if length - shortest < len(shared.value) else np.zeros(len(at), dtype=bool)
                    width[at[~hot]], code_at[at[~hot]] = length, code[~hot]
                    at = at[hot]
                place = np.flatnonzero(width)
                owner = np.repeat(np.arange(len(some)), size)[place]
                begin = place - marked.first[owner]
                end = begin + width[place]
                first, last = np.full(len(some), -1), np.full(len(some), -1)
                order = np.lexsort((-begin, end, owner))             # of grams that end together, the shortest
                first[owner[order][::-1]] = order[::-1]
                last[owner] = np.arange(len(place))                  # places ascend within a word: the last one stays
                has = first >= 0
                bound = np.zeros(len(some), dtype=np.int32)
                bound[has] = end[first[has]] <= begin[last[has]]
                for chosen, salt, offset in ((first, 0x51, begin), (last, 0xA7, size[owner] - begin)):
                    key = np.zeros(len(some), dtype=_U)
                    key[has] = W.mix(code_at[place[chosen[has]]] + W.mix(offset[chosen[has]].astype(_U) * _U(512) + _U(salt)))
                    yield pa.record_batch([pa.array(W.signed(key), mask=~has), batch.column(0).slice(lo, len(some)), batch.column(1).slice(lo, len(some)), pa.array(bound)],
                                          names=["key", "word", "n", "bound"])

    return words.select(F.col(word).alias("word"), F.col(n).alias("n")).mapInArrow(cut, "key long, word string, n long, bound int")


def deletions(words: DataFrame, word: str = "word") -> DataFrame:
    """(key, id): hashes of each word and of all strings that one deletion makes of it; id: a hash of the word.
    Two words within one edit share a key."""

    def delete(batches):
        for batch in batches:
            for lo, some in _batches(batch.column(0)):
                marked = _Marked(some)
                owner = np.repeat(np.arange(len(some)), marked.size)
                inside = np.flatnonzero((marked.room > 1) & (np.arange(len(owner)) != marked.first[owner]))
                key = np.concatenate([W.codes_without(marked.code, marked.first[owner[inside]], marked.first[owner[inside] + 1], inside),
                                      W.sequence_codes(marked.code, marked.first[:-1], marked.size)])
                of = np.concatenate([owner[inside], np.arange(len(some))])
                order = np.lexsort((key, of))                        # in a run of equal letters all deletions are one
                key, of = key[order], of[order]
                new = np.concatenate([[True], (np.diff(of) != 0) | (key[1:] != key[:-1])]) if len(of) else np.zeros(0, dtype=bool)
                yield pa.record_batch([pa.array(W.signed(key[new])), batch.column(1).take(pa.array(of[new] + lo))], names=["key", "id"])

    return words.select(F.col(word).alias("word"), F.xxhash64(word).alias("id")).mapInArrow(delete, "key long, id long")


def near_pairs(words: DataFrame, scratch: Scratch, frequent: int = FREQUENT, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of words one edit apart, a < b. ``words``: (word, n), distinct words."""
    dictionary = gram_dictionary(words, frequent=frequent, shortest=shortest, longest=longest)
    grams = scratch.write(border_grams(words, dictionary, shortest=shortest, longest=longest))
    left = grams.where("key IS NOT NULL").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("bound").alias("a_bound"))
    right = grams.where("key IS NOT NULL").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("bound").alias("b_bound"))
    one_edit = F.levenshtein("a", "b", 1) == 1
    merged = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.col("a_bound") + F.col("b_bound") > 0)
                       & (F.abs(F.char_length("a") - F.char_length("b")) <= 1) & one_edit)
    # words without a bound, among themselves
    loose = grams.where("bound = 0").select("word", "n").distinct()
    keys = scratch.write(deletions(loose))
    x, y = keys.select("key", F.col("id").alias("a_id")), keys.select(F.col("key").alias("key_"), F.col("id").alias("b_id"))
    met = x.join(y, (F.col("key") == F.col("key_")) & (F.col("a_id") < F.col("b_id"))).select("a_id", "b_id").distinct()
    named = loose.select(F.xxhash64("word").alias("id"), "word", "n")
    met = met.join(named.select(F.col("id").alias("a_id"), F.col("word").alias("x"), F.col("n").alias("x_n")), "a_id").join(
        named.select(F.col("id").alias("b_id"), F.col("word").alias("y"), F.col("n").alias("y_n")), "b_id")
    low = F.col("x") < F.col("y")
    met = met.select(F.least("x", "y").alias("a"), F.when(low, F.col("x_n")).otherwise(F.col("y_n")).alias("a_n"),
                     F.greatest("x", "y").alias("b"), F.when(low, F.col("y_n")).otherwise(F.col("x_n")).alias("b_n")).where(one_edit)
    return merged.select("a", "a_n", "b", "b_n").unionByName(met).distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): the last word that the forms lead to. Pointers double their reach each round; a form
    occurs TIMES as often as its word, so a chain is short."""
    here = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = here.select(F.col("word").alias("w"), F.col("root").alias("next"))
        new = scratch.write(here.join(ahead, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        scratch.drop(here)
        path = new.scratch_path
        here = new.select("word", "root")
        here.scratch_path = path


def group_variants(words: DataFrame, times: int = TIMES, frequent: int = FREQUENT, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of ``words`` (word, n): the near word of
    largest n is a word's form, if it occurs ``times`` as often or more."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.write(words.select("word", "n"))
    pairs = scratch.write(near_pairs(words, scratch, frequent, shortest, longest))
    sides = pairs.select(F.col("a").alias("w"), F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("form")).alias("near")).unionByName(
        pairs.select(F.col("b").alias("w"), F.struct((-F.col("a_n")).alias("m"), F.col("a").alias("form")).alias("near")))
    best = sides.groupBy("w").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    rows = words.join(best, F.col("word") == F.col("w"), "left")
    far = -F.col("near.m") >= times * F.col("n")
    rows = scratch.write(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                     F.when(far, F.col("near.form")).alias("form"), F.when(far, -F.col("near.m")).alias("form_n")))
    roots = _roots(rows.where("form IS NOT NULL"), scratch).select(F.col("word").alias("w"), "root")
    out = rows.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    return scratch.finish(out)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_variants(corpus_words(docs).where(F.col("n") >= LEAST_COUNT))


ORACLE = r"""
WITH RECURSIVE occ AS (SELECT doc_id, run, count(*) AS k FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
named AS (SELECT run, k, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM occ),
coded AS (SELECT run, k, xor(4294967295, list_reduce([4294967295] || list_transform(range(0, strlen(s)), lambda i: ('0x' || substr(hex(s), 2 * i + 1, 2))::BIGINT),
  lambda a, x: list_reduce([xor(a, x)] || range(8), lambda y, j: xor(y >> 1, 3988292384 * (y & 1))))) AS h FROM named),
word AS (SELECT w, sum(k)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS w, k FROM coded)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(k) >= 2),
del AS (SELECT w, length(w) AS size, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM word)),
near AS (SELECT x.w AS a, y.w AS b FROM del x JOIN del y ON x.i = y.i AND x.d = y.d AND x.size = y.size AND x.w <> y.w
  UNION SELECT del.w, word.w FROM del JOIN word ON word.w = del.d UNION SELECT word.w, del.w FROM del JOIN word ON word.w = del.d),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS n FROM near JOIN word ON word.w = b GROUP BY a),
row_ AS (SELECT w, word.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best.n >= 10 * word.n THEN b END AS form, CASE WHEN best.n >= 10 * word.n THEN best.n END AS form_n
  FROM word LEFT JOIN best ON a = w),
chain AS (SELECT w, w AS at FROM row_ UNION ALL SELECT chain.w, row_.form FROM chain JOIN row_ ON row_.w = chain.at WHERE row_.form IS NOT NULL)
SELECT row_.w AS word, row_.form, e.at AS root, row_.n, row_.n_near, row_.form_n
FROM row_ JOIN (SELECT chain.w, chain.at FROM chain JOIN row_ ON row_.w = chain.at WHERE row_.form IS NULL) e ON e.w = row_.w
"""
