import hashlib
import random

import pytest

from larder.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, extra int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("budget,history", [(2048, 2), (16, 2), (12, 0), (40, 5)])
def test_windows_read_back_every_turn_once(spark, tmp_path, budget, history):
    rows = [(1, t, ["system", "user", "assistant"][min(t, 1 + (t + 1) % 2)] if t else "system", "é😀 word " * (t % 5), 0) for t in range(1300)]
    rows += [(2, 0, "user", r"\### Assistant: </turn> ok\b\l<turn>\n", 0), (2, 1, "assistant", "</turn>\n<turn>assistant\nx", 0),
             (2, 1, "assistant", "</turn>\n<turn>assistant\nx", 0), (3, None, None, None, 0), (None, 5, "assistant", "lost", 0), (None, None, "a\nb<", "", 0),
             (4, 0, "user", "w " * 300, 0), (4, 1, "assistant", "", 0), (-5, 600, "assistant", "far", 0), (-5, -600, "system", "s", 0)]
    made = C.windows(spark.createDataFrame(rows, SCHEMA), budget, history)
    read = C.read_back(made).collect()
    got = {}
    for r in sorted(read, key=lambda r: r["window"]):
        got.setdefault(r["conv_id"], []).append(r)
    assert set(got) == {r[0] for r in rows}
    for conv, (n, digest, chars, loss) in expected(rows).items():
        turns = [t for r in got[conv] for t in r["turns"]]
        targets = "".join(t for r in got[conv] for t in r["targets"])
        assert len(turns) == n
        assert sha("".join(f"{t['role']}\n{t['text']}\n" for t in turns)) == digest
        assert (len(targets), sha(targets)) == (chars, loss)
    for r in got[1]:                                      # the system turn stays, the history is limited
        assert r["formatted"].startswith("<turn>system\n")
        assert r["n_kept"] - r["n_new"] <= history + 1
    if budget == 2048:
        words = [sum(len(t["text"].split()) + C.OVERHEAD for t in r["turns"]) for r in got[1]]
        assert len(words) > 1 and max(words) <= budget * 3 / 4


@pytest.mark.parametrize("system,history", [(0, 2), (300, 3), (800, 2), (1500, 5)])
def test_whole_windows_stay_within_the_budget(spark, system, history):
    """System turn, history and new turns together, for turns of any cost up to half of the room for new ones."""
    budget, rng = 2048, random.Random(system)
    most = int((budget - system - C.OVERHEAD) * 3 / 4 / 2) - C.OVERHEAD
    rows = [(1, 0, "system", "s " * system, 0)] if system else []
    rows += [(1, t, ["user", "assistant"][t % 2], "w " * rng.randint(0, most), 0) for t in range(1, 400)]
    made = C.windows(spark.createDataFrame(rows, SCHEMA), budget, history).collect()
    costs = [sum(len(part.split("\n", 1)[1].split()) + C.OVERHEAD for part in r["formatted"].split(C.CLOSE)[:-1]) for r in made]
    assert len(made) > 10 and max(costs) <= budget
    assert history == 0 or any(r["n_kept"] - r["n_new"] > bool(system) for r in made)


def test_null_ids_and_an_id_named_null_are_apart(spark):
    rows = [("null", 0, "system", "keep"), ("null", 1, "user", "a"), (None, 0, "user", "b"), (None, 1, "assistant", "c")]
    made = C.windows(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["first_idx"], r["n_new"], r["n_kept"]) for r in made} == {("null", 0, 2, 2), (None, 0, 2, 2)}


def test_no_python_in_the_plan(spark):
    plan = C.op5_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Arrow", "Pandas", "ScalaUDF") if word in plan]


def test_empty_table(spark):
    assert C.read_back(C.windows(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in C.op5_chat_format(spark, sf).collect()}
    assert got == expected(rows)
