import zlib

import numpy as np

from larder.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = L.op9_language_id(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.98


def make(spark, rows):
    return spark.createDataFrame([(i, t, g, "z", 9.0) for i, t, g in rows], "doc_id long, text string, lang string, lang_pred string, score double")


def test_edges_and_ties(spark):
    rows = [(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, None, "en"), (4, "123 !!", "en"), (5, "", None), (6, "the dog", None), (None, "the cat", "en"),
            (2, "the dog and the cat", "en"), (7, "the dog and the cat " * 9000, None)]
    df = make(spark, rows)
    got = L.predict(df, L.train(df)).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got}
    for key in ((3, None), (4, "123 !!"), (5, "")):
        assert by[key] == ("und", 0.0)
    assert by[(6, "the dog")][0] == by[(None, "the cat")][0] == by[rows[-1][:2]][0] == "en" and by[rows[0][:2]][0] == "de"
    none = make(spark, [])
    assert L.predict(none, L.train(none)).count() == 0
    assert [r["lang_pred"] for r in L.predict(df, L.train(none)).collect()] == ["und"] * len(rows)


def test_scores_match_brute_force_in_any_chunks(spark, monkeypatch):
    rows = [(i, ["aab abba ßa", "bbc cab é"][i % 2] * (i + 1), ["x", "y"][i % 2]) for i in range(6)]
    df = make(spark, rows)
    model = L.train(df)
    want = []
    for _, text, _ in rows:
        total = model.log_prior.copy()
        padded = "\0\0" + text.lower()
        codes = np.array([ord(c) if c.isalpha() or c == "\0" else 32 for c in padded], dtype=np.uint32)
        for k in range(2, len(codes)):
            c0, c1, c2 = (int(codes[k - j]) for j in range(3))
            two = (c0 * 0x85EBCA6B + c1 * 0xC2B2AE35) % 2**32
            three = (two + c2 * 0x27D4EB2F + 0x165667B1) % 2**32
            for x in (two, three):
                total = total + model.log_prob[((x ^ (x >> 15)) * 0x9E3779B1 % 2**32) >> (32 - L.BUCKET_BITS)]
        want.append((model.labels[int(total.argmax())], 1 / np.exp(total - total.max()).sum()))
    for chunk in (1 << 17, 3):
        monkeypatch.setattr(L, "CHUNK_CHARS", chunk)
        texts = [t for _, t, _ in rows]
        total = np.tile(model.log_prior, (len(texts), 1))
        for joined, of, lengths in L._units(texts):
            grams, _, _ = L._grams(joined, lengths)
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            for row in grams:
                np.add.at(total, np.asarray(of), np.add.reduceat(model.log_prob[row], first, axis=0, dtype=np.float64))
        assert [model.labels[k] for k in total.argmax(axis=1)] == [w[0] for w in want]
        assert np.allclose(1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1), [w[1] for w in want], atol=1e-4)


def test_copies_of_a_text_are_drawn_one_by_one(spark):
    """The sample keeps its size however often one text occurs."""
    rows = [(i, "the same text" if i % 2 else f"text {i}", "en") for i in range(6000)]
    df = make(spark, rows)
    draw = L.F.pmod(L.F.xxhash64("doc_id", "text"), L.F.lit(L.DRAWS))
    n = df.where(draw < int(L.DRAWS * 100 / 6000)).count()
    assert 60 <= n <= 150
    texts = df.where(draw < int(L.DRAWS * 100 / 6000)).groupBy("text").count().where("text = 'the same text'").first()
    assert 20 <= texts["count"] <= 80
