"""BPE encoding against the tokenizers library, on random, odd and very long texts."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(bpe.read_vocabulary(PATH))


def split(flat, sizes):
    at, out = 0, []
    for n in sizes:
        out.append(list(flat[at:at + n]))
        at += n
    return out


def same(vocab, library, texts, **kw):
    encoder = bpe.Encoder(vocab, **kw)
    assert split(*encoder.ids(texts)) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts(vocab, library):
    rng = random.Random(5)
    letters = "aeinort hT'slver \n\t0129.,!-_é日🙂ʼ힣"
    same(vocab, library, ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(5000)])
    same(vocab, library, [bytes(rng.choices(range(256), k=30)).decode("latin1") for _ in range(2000)])


def test_runs_of_equal_parts(vocab, library):
    """Equal merges go from left to right."""
    same(vocab, library, [part * k for part in ("a", "ab", "aab", " ", "=", "-=", "\n ", "ha", "é") for k in range(70)])


def test_blanks_and_special_tokens(vocab, library):
    same(vocab, library, ["x<|endoftext|> y  <|endoftext|><|endoftext|>z", "<|endoftext|>", "<|endoftext", " a  b \n\n c ", "\x1c\x1d a\x85b　", "can't  'sit'", ""])


def test_letters_of_newer_unicode_versions(vocab, library):
    """Every code point that the two libraries class differently, and a sample of all others."""
    odd = [c for a, b in bpe.newer_characters() for c in range(a, b + 1, max(1, (b - a) // 9))]
    rest = [c for c in range(1, 0x110000, 37) if not 0xD800 <= c <= 0xDFFF]
    same(vocab, library, [f"a{chr(c)}1{chr(c)}{chr(c)}!{chr(c)}" for c in odd + rest])


def test_every_token_of_the_vocabulary(vocab, library):
    texts = [b.decode() for b in vocab.bytes.values() if not _broken(b)]
    same(vocab, library, texts[::7] + [x + y for x, y in zip(texts[::11], texts[5::11])])


def _broken(b):
    try:
        b.decode()
        return False
    except UnicodeDecodeError:
        return True


def test_long_texts_are_cut_where_no_word_goes_across(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 50)
    same(vocab, library, ["some  words \n\n and   more " * 40, "x" * 500, "a b" * 100, " " * 300, "word " * 200], known=20)


def test_shared_prefixes_are_walked_once(vocab):
    trie = bpe.Trie([b"over", b"overt", b"overture", b"ove", b"on"])
    assert trie.nodes() == len("overture") + len("n")


def test_tables(spark, docs, library):
    rows = [(1, "Hello world"), (None, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (4, "long " * 30000 + "é日🙂")]
    table = docs(rows)
    got = bpe.decode(bpe.encode(table, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert all(r.ids == library.encode(r.decoded, add_special_tokens=False).ids for r in got)
    assert bpe.decode(bpe.encode(table.limit(0), PATH), PATH).count() == 0


def test_decoding_unknown_ids_and_broken_bytes(spark, library):
    rows = [([220, 60000, -1, 39],), ([50256, 447],), ([447, 247, 447],), ([],)]
    got = bpe.decode(spark.createDataFrame(rows, "ids array<int>"), PATH).collect()
    want = [library.decode([i for i in ids if 0 <= i < 50257], skip_special_tokens=False) for ids, in rows]
    assert [r.decoded for r in got] == want


def test_query(spark, library):
    found = {r.doc_id: r for r in bpe.op12_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids, row = library.encode(doc.text or "", add_special_tokens=False).ids, found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
