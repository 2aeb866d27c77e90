import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import words as W

RULES = {W.SPACE: r"[^\x20\x09-\x0D]+", W.NON_ALNUM: r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(text, seps):
    return re.findall(RULES[seps], fold(text or ""))


def via_arrays(texts, seps):
    data, offs, _ = W.text_buffers(pa.array(texts, pa.string()))
    out = []
    for lo, hi in W.pieces(offs, 64):
        w = W.split_words(data, offs[lo:hi + 1], W.separator_table(seps), True)
        for k in range(hi - lo):
            a, b = w.first[k], w.first[k + 1]
            out.append(([bytes(W.FOLD[data[s:e]]).decode() for s, e in zip(w.start[a:b], w.end[a:b])], list(w.code[a:b])))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAZ é9_ \n\t-", max_size=60)), max_size=8))
def test_words_match_the_pattern(texts):
    for seps in RULES:
        got = via_arrays(texts, seps)
        assert [g[0] for g in got] == [brute(t, seps) for t in texts]
        names = {}
        for found, codes in got:
            for word, code in zip(found, codes):
                assert names.setdefault(word, code) == code
        assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("chunk", [1, 2, 5, 17])
def test_chunks_do_not_change_words(monkeypatch, chunk):
    texts = ["aa bb  cc", "", "x" * 40, None, " dd\nee ", "é è ff" * 9, "z"]
    whole = via_arrays(texts, W.SPACE)
    monkeypatch.setattr(W, "CHUNK", chunk)
    assert via_arrays(texts, W.SPACE) == whole


def test_sequence_codes_name_sequences():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 5, 300).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = np.arange(300 - 6)
    for second in (False, True):
        got = W.sequence_codes(code, at, 6, second)
        assert len(set(got)) == len({tuple(code[i:i + 6]) for i in at})
