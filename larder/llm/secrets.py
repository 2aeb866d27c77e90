"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of a text is named by the SHA-256 of its bytes (its blob). A ledger
row holds a blob, the rule versions that were run on it and the spans found. A
scan runs, once per distinct blob, only the rule versions that the ledger lacks
for it; findings go back to all rows (paths) that hold the blob by a join.

Spans count code points, end exclusive. Matches are leftmost and do not overlap
within a rule; the gaps between them come from splitting the text by the same
pattern, and a running sum over gaps and matches places them.

Defined cases: a null text counts as empty; empty texts have no spans; repeated
rows and copies share one blob; ids pass through, null or repeated; a blob that
the ledger lists for every rule is not scanned again; an empty table gives no rows; a text of any length, with any
number of spans, is scanned whole; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch


@dataclass(frozen=True)
class Rule:
    """A pattern; of its matches those stay whose ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", 1, r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),     # a run is one match, so shorter ones can be left out at once
)
RULES = (*BASE, Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1))

#: A whole PEM block: from the header to its END line, no other BEGIN between; without an END line, over the
#: header fields and base64 lines that follow, however many. All runs are possessive, so long texts cost no stack.
_PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
        r"|(?:(?:(?:\s|\\[nr])*+[A-Za-z-]++: [^\n\\]*+)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{32,}+)++(?:(?:\s|\\[nr])++[A-Za-z0-9+/=]++(?=\s|\\[nr]|$))?+)?+)")
#: ``RULES`` with whole private keys: what must leave a text. The first version finds the header line alone.
REDACTED = (*BASE, Rule("private_key", 2, _PEM, 0, 1))

LEDGER_SCHEMA = "blob string, rules array<string>, spans array<struct<start:int,rank:int,end:int,kind:string>>"


def blob_id(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _matches(rule: Rule, rank: int, wanted):
    """(rank, position, gap before, characters, kept) of each match of a rule."""
    text, pattern = F.col("__text"), F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    value = lambda m: F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m
    kind = "array<struct<rank:int,at:int,gap:int,size:int,kept:boolean>>"
    rows = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("m")), lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("at"), F.char_length(x["g"]).alias("gap"), F.char_length(x["m"]).alias("size"),
        (F.char_length(value(x["m"])) >= rule.least).alias("kept")))
    return F.when(wanted & text.rlike(rule.pattern), rows.cast(kind)).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, ledger: DataFrame | None = None, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the (blob, rule version) pairs of ``docs`` that ``ledger`` lacks."""
    blobs = docs.select(blob_id(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("__text")).dropDuplicates(["blob"])
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        blobs = blobs.withColumn("rules", names)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("__seen"))
        blobs = (blobs.join(seen, "blob", "left")
                 .withColumn("rules", F.array_except(names, F.coalesce("__seen", F.array().cast("array<string>"))))
                 .where(F.size("rules") > 0))
    found = F.concat(*[_matches(r, k, F.array_contains("rules", r.name)) for k, r in enumerate(rules)])
    rows = blobs.select("blob", "rules", F.explode_outer(found).alias("m")).select("blob", "rules", "m.*")
    placed = Window.partitionBy("blob", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank") + 1)
    end = F.sum(F.col("gap") + F.col("size")).over(placed).cast("int")
    spans = rows.withColumn("end", end).select(
        "blob", "rules", F.when(F.col("kept"), F.struct((F.col("end") - F.col("size")).alias("start"), "rank", "end", kind.alias("kind"))).alias("span"))
    return spans.groupBy("blob").agg(F.first("rules").alias("rules"), F.sort_array(F.collect_list("span")).alias("spans"))


def findings(docs: DataFrame, ledger: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row with the spans of its blob from all of the ledger."""
    paths = docs.select(*keep, blob_id(text).alias("__blob"))
    hits = ledger.where(F.size("spans") > 0).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    hits = hits.groupBy("__blob").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("__spans")))).alias("__spans"))
    hits = Scratch(docs.sparkSession, "findings").write(hits)      # so that both sides are plain shuffles, which Spark splits where a blob has very many paths
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return paths.join(hits, "__blob", "left").select(*keep, F.coalesce("__spans", none).alias("spans"))


CHUNK = 128                  # spans whose furthest end is looked up together


def redact(text, spans):
    """The text with every span replaced by [REDACTED]; spans that overlap become one.

    A span's part begins at the furthest end before it: that of all chunks of spans before its own, held once,
    or of the few spans before it in its chunk. Parts are cut out of the text in UTF-32, where a code point's
    place is known, so a text with many spans is not read from its start for each."""
    width = F.lit(CHUNK)
    end_of = lambda some: F.coalesce(F.array_max(F.transform(some, lambda s: s["end"])), F.lit(0))
    chunks = F.sequence(F.lit(0), F.floor(F.size(spans) / width).cast("int"))
    ends = F.transform(chunks, lambda c: end_of(F.slice(spans, c * width + 1, width)))
    one = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  (a value computed once)

    def parts(code, leads):
        before = lambda k: F.greatest(F.get(leads, F.floor(k / width).cast("int")),
                                      end_of(F.slice(spans, (F.floor(k / width) * width).cast("int") + 1, (k % width).cast("int"))))
        piece = lambda a, b: F.decode(F.substring(code, a * 4 + 1, (b - a) * 4), "UTF-32")
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), lambda k: one(before(k), lambda at: F.when(
            k == F.size(spans), piece(at, F.char_length(text))).when(
            (k > 0) & (F.get(spans, k)["start"] < at), F.lit("")).otherwise(
            F.concat(piece(at, F.get(spans, k)["start"]), F.lit("[REDACTED]"))))), "")

    leads = lambda ends: F.transform(chunks, lambda c: F.coalesce(F.array_max(F.slice(ends, 1, c)), F.lit(0)))
    cut = one(F.encode(text, "UTF-32"), lambda code: one(ends, lambda e: one(leads(e), lambda led: parts(code, led))))
    return F.when(F.size(spans) == 0, text).otherwise(cut)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = findings(docs, scan(docs), ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _duck(kind: str, rank: int, pattern: str, value: str, least: int) -> str:
    return f"""SELECT row_id, {rank} AS rank, '{kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, p FROM (
      SELECT row_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM t) WHERE len(m) > 0"""


_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_duck('assign', 0, _ASSIGN, '', 6)}
  UNION ALL {_duck('access', 1, 'AKIA[A-Z0-9]+', '', 20)}
  UNION ALL {_duck('hex', 2, '[0-9a-f]+', '', 24)}
  UNION ALL {_duck('private_key', 3, '-----BEGIN [A-Z ]*PRIVATE KEY-----', '', 1)}),
s AS (
  SELECT row_id, rank, kind, m[i] AS hit,
    (list_sum([length(x) for x in p[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0))::BIGINT AS a
  FROM m),
k AS (
  SELECT row_id, rank, kind, a, a + length(hit) AS b FROM s
  WHERE CASE rank WHEN 0 THEN length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6 WHEN 1 THEN length(hit) >= 20 WHEN 2 THEN length(hit) >= 24 ELSE true END),
g AS (
  SELECT row_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans
  FROM k GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (row_id)
"""
