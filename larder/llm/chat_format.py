r"""Chat formatting: conversations as budgeted, turn-aligned windows.

Each turn is written ``<turn>ROLE\nTEXT</turn>\n``. Inside roles and texts a
backslash becomes ``\b`` and ``<`` becomes ``\l`` (in roles a line break becomes
``\n``), so no text can hold a mark, and undoing it gives the text back.

A turn costs its words plus ``OVERHEAD``. Prefix sums of the costs choose the
windows: a turn belongs to the window in which its prefix sum starts, on a grid of
half the budget left after the system turn and the history. A whole window, system turn and history
included, therefore stays within the budget unless one turn alone is longer than half of what
is left for new turns (or the system turn leaves nothing). Every
window starts with the conversation's leading system turn, then repeats up to
``history`` turns before it; both are outside the loss mask, so each assistant
text is a target once. Prefix sums run per block of turns first, then over blocks,
so that one huge conversation is spread over tasks.

Defined cases: null texts are empty, null roles too (and no target); turns are in
order of turn (null first), then role and text; repeated rows are turns of their
own; rows with a null conv_id are one conversation, apart from one named ``null``; an empty table has no
window; a text of any length stays in one piece; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUDGET = 2048
HISTORY = 2
OVERHEAD = 4
BLOCK = 512                  # turn numbers that one task orders together
OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text):
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text):
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role):
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role):
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _indexed(rows: DataFrame) -> DataFrame:
    """Adds idx (0, 1, .. within the conversation) and before (cost of all turns before)."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60))))
    sums = rows.groupBy("conv", "block").agg(F.sum("cost").alias("block_cost"), F.count("*").alias("block_turns"))
    past = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv").alias("c"), F.col("block").alias("b"),
                       F.coalesce(F.sum("block_cost").over(past), F.lit(0)).alias("lead_cost"),
                       F.coalesce(F.sum("block_turns").over(past), F.lit(0)).alias("lead_turns"))
    inside = Window.partitionBy("conv", "block").orderBy(*order)
    rows = rows.withColumn("idx", F.row_number().over(inside) - 1).withColumn(
        "before", F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cost"))
    return rows.join(sums, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv", "conv_id", "turn", "role", "text", "cost", (F.col("idx") + F.col("lead_turns")).alias("idx"), (F.col("before") + F.col("lead_cost")).alias("before"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, first_idx, n_new, n_kept, formatted, loss): loss spans count code
    points, end exclusive; the last n_new turns of a window are its own."""
    rows = conversations.select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _indexed(rows.withColumn("cost", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + OVERHEAD))
    # the leading system turn goes into every window
    system = rows.where("idx = 0 AND role = 'system'").select(F.col("conv").alias("sys_conv"), F.col("text").alias("sys_text"), F.col("cost").alias("sys_cost"))
    rows = rows.join(system, F.col("conv") == F.col("sys_conv"), "left").drop("sys_conv")
    free = F.lit(budget) - F.coalesce("sys_cost", F.lit(0))               # what the system turn leaves: three quarters for new turns, one for the history
    room = F.greatest(F.lit(2), F.floor(free * 3 / 4))
    rows = rows.withColumn("window", F.floor(F.col("before") / (room / 2)).cast("long"))
    head = F.struct(F.col("idx"), F.col("before"))
    spans = rows.groupBy("conv", "window").agg(F.min(head).alias("head"))
    # a window's history: the turns before its first one, while they fit in a quarter of what is free
    wanted = spans.select("conv", "window", F.col("head.before").alias("at"), F.explode(F.sequence(F.lit(1), F.lit(history))).alias("back"), F.col("head.idx").alias("first")).where("first - back >= 0") \
        .select(F.col("conv").alias("c"), F.col("window").alias("w"), "at", (F.col("first") - F.col("back")).alias("i")) if history else None
    own = rows.select("conv", "conv_id", "window", "idx", "role", "text", F.lit(True).alias("new"))
    parts = own
    if wanted is not None:
        told = rows.join(wanted, (F.col("conv") == F.col("c")) & (F.col("idx") == F.col("i")))
        told = told.where((F.col("at") - F.col("before") <= F.floor(free / 4)) & ~((F.col("idx") == 0) & (F.col("role") == "system")))
        parts = parts.unionByName(told.select("conv", "conv_id", F.col("w").alias("window"), "idx", "role", "text", F.lit(False).alias("new")))
    parts = parts.unionByName(rows.where("sys_text IS NOT NULL").groupBy("conv", "conv_id", "window").agg(F.min("idx").alias("least"), F.first("sys_text").alias("text"))
                              .where("least > 0").select("conv", "conv_id", "window", F.lit(0).cast("long").alias("idx"), F.lit("system").alias("role"), "text", F.lit(False).alias("new")))
    lead = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    parts = parts.select("conv", "conv_id", "window", F.struct(
        "idx", "new", F.concat(lead, body, F.lit(CLOSE)).alias("s"), F.char_length(lead).alias("lead"), F.char_length(body).alias("body"),
        ((F.col("role") == "assistant") & F.col("new")).alias("target")).alias("p"))
    made = parts.groupBy("conv", "conv_id", "window").agg(F.sort_array(F.collect_list("p")).alias("p"))
    size = lambda p: p["lead"] + p["body"] + len(CLOSE)
    start = F.aggregate("p", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans")), lambda acc, p: F.struct(
        (acc["at"] + size(p)).alias("at"),
        F.when(p["target"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + p["lead"]).alias("begin"), (acc["at"] + p["lead"] + p["body"]).alias("end"))))).otherwise(acc["spans"]).alias("spans")))
    new = F.filter("p", lambda p: p["new"])
    return made.select("conv", "conv_id", "window", F.get(new, F.lit(0))["idx"].alias("first_idx"), F.size(new).alias("n_new"), F.size("p").alias("n_kept"),
                       F.array_join(F.transform("p", lambda p: p["s"]), "").alias("formatted"), start["spans"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (role and text of the window's own turns) and targets (texts under the loss mask)."""
    parts = F.filter(F.split("formatted", CLOSE, -1), lambda s: s != "")
    own = F.slice(parts, F.size(parts) - F.col("n_new") + 1, F.col("n_new"))
    turn = lambda s: F.struct(unescape_role(F.substring(F.substring_index(s, "\n", 1), len(OPEN) + 1, 1 << 30)).alias("role"),
                              unescape(F.substring(s, F.char_length(F.substring_index(s, "\n", 1)) + 2, 1 << 30)).alias("text"))
    targets = F.transform("loss", lambda x: unescape(F.substring("formatted", x["begin"] + 1, x["end"] - x["begin"])))
    return formatted.withColumns({"turns": F.transform(own, turn), "targets": targets})


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.sql(f"SELECT CAST(-7 AS BIGINT) conv_id, CAST(id AS BIGINT) turn, IF(id = 0, 'user', 'assistant') role, r'{tricky}' text FROM range(2)")
    read = read_back(windows(table.unionByName(extra)))
    rows = read.select("conv", "conv_id", "window", F.struct(
        "window", F.size("turns").alias("n"), F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("loss"), F.char_length("formatted").alias("chars")).alias("x"))
    whole = rows.groupBy("conv", "conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    total = lambda name: F.aggregate("x", F.lit(0).cast("long"), lambda a, x: a + x[name])
    text = lambda name: F.array_join(F.transform("x", lambda x: x[name]), "")
    return whole.select("conv_id", total("n").alias("n_turns"), F.sha2(text("said"), 256).alias("turns_sha256"),
                        F.char_length(text("loss")).cast("long").alias("loss_chars"), F.sha2(text("loss"), 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))
