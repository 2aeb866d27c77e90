"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

The words (pre-tokens) that a task meets for the first time go, distinct, into a
trie of their bytes (in order, with what each shares with the one before). It is walked depth first; the state of a node is the last token of the
encoding of the bytes from the root to it, which determines the rest: without
that token's bytes one stands at an earlier node of the path, whose state is
the token before it. So the encoding of a prefix that many words share is computed
once, and a word's tokens are read off its path from the end.

The last token of a node is the one token ending there whose border to the state
before it outlasts all merges (``Vocabulary.joins``). There is exactly one: BPE
encodes every prefix of its own output as that output's prefix.

Encodings of words already met stay in the task, the ``KNOWN`` that came last; texts are read in
pieces, very long ones cut at a blank between two non-blanks, where
no pre-token can go across. Nothing is shuffled. The vocabulary file is read by the driver and broadcast
(its size is the tokenizer's, whatever the input).

Defined cases: a null text is an empty one and has no tokens; special tokens of the file that
occur in a text are encoded as such; ids outside the vocabulary decode to nothing; bytes that are
no UTF-8 decode to U+FFFD; rows are taken one by one, so repeated rows, null ids and an
empty table need no care; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import words as W

KNOWN = 1 << 18              # words whose encoding a task keeps, some 200 bytes each
STEPS = 1 << 19              # steps between states that a task knows
BORDERS = 1 << 18            # pairs of tokens whose border a task knows
LONG = 1 << 20               # code points of a text that are split in one go
NEVER = 1 << 60              # rank of a merge that does not happen

# Fixed value: the public pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STAND_IN = "͸"          # a code point that no Unicode version assigns: neither letter, number nor blank


def byte_characters() -> dict[str, int]:
    """The file's character for every byte: printable ones stand for themselves, the
    others take the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, given as its JSON text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or spec["normalizer"] \
                or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError("only plain byte-level BPE files are read")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens must match their text alone")
        code = byte_characters()
        self.bytes = {i: bytes(code[c] for c in t) for t, i in model["vocab"].items()}
        self.ids = {b: i for i, b in self.bytes.items()}
        self.size = {i: len(b) for i, b in self.bytes.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}          # two tokens -> rank, token
        self.parts: dict[int, tuple[int, int, int]] = {}                 # token -> its parts, rank
        for rank, pair in enumerate(model["merges"]):
            a, b = (model["vocab"][x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = self.ids[self.bytes[a] + self.bytes[b]]
            if made in self.parts or any(self.parts[x][2] >= rank for x in (a, b) if x in self.parts):
                raise ValueError("a merge must be the only one of its token and come after those of its parts")
            self.merge[a, b], self.parts[made] = (rank, made), (a, b, rank)
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("every byte must be a token")
        self._real: dict[int, bool] = {}
        self.known_borders: dict[int, bool] = {}
        self.step: dict[int, int] = {}               # state << 8 | byte -> state; others are found once, by ``enter``

    def link(self) -> None:
        """Makes what encoding needs beyond decoding. States are the beginnings of tokens. A text is in the state of the longest one it ends with;
        ``longest`` is the longest token it ends with, ``shorter`` the next one within a token."""
        if self.step:
            return
        self.packed = {i: i.to_bytes(4, sys.byteorder) for i in self.bytes}
        tokens = {i: b for i, b in self.bytes.items() if (len(b) == 1 or i in self.parts) and self.real(i)}
        self.longest, self.shorter = [-1], {}
        depth, whole = [0], {}
        for token in sorted(tokens, key=tokens.get):
            state = 0
            for b in tokens[token]:
                nxt = self.step.get(state << 8 | b)
                if nxt is None:
                    nxt = self.step[state << 8 | b] = len(self.longest)
                    self.longest.append(-1)
                    depth.append(depth[state] + 1)
                state = nxt
            whole[state] = token
        self.fall = [0] * len(self.longest)          # the state of a state's text without its first byte
        for key, state in sorted(self.step.items(), key=lambda x: depth[x[1]]):
            above, byte = key >> 8, key & 255
            self.fall[state] = self.enter(self.fall[above], byte) if above else 0
            end = self.longest[self.fall[state]]
            token = whole.get(state)
            self.longest[state] = end if token is None else token
            if token is not None:
                self.shorter[token] = end

    def enter(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        passed = []
        while True:
            nxt = self.step.get(state << 8 | byte)
            if nxt is not None:
                break
            passed.append(state)
            state = self.fall[state]                 # ends at the root, where every byte has a step
        if len(self.step) < STEPS:
            for state in passed:
                self.step[state << 8 | byte] = nxt
        return nxt

    def _edge(self, token: int, side: int, gone: int):
        """The tokens at one end of ``token`` while it is built up, last first, each with the rank of the merge that ends it."""
        while True:
            yield token, gone
            if token not in self.parts:
                return
            token, gone = self.parts[token][side], self.parts[token][2]

    def _border(self, a: int, b: int, gone: int) -> bool:
        """No merge goes across the border of a and b before rank ``gone``. Of equal merges the leftmost comes first."""
        merge = self.merge
        right = list(self._edge(b, 0, gone))
        for x, end_x in self._edge(a, 1, gone):
            for y, end_y in right:
                m = merge.get((x, y))
                if m is not None and m[0] < end_x and m[0] <= end_y and m[0] < gone:
                    return False
        return True

    def real(self, token: int) -> bool:
        """The token's own bytes are encoded as this token."""
        known = self._real.get(token)
        if known is None:
            a, b, rank = self.parts.get(token, (None, None, None))
            known = self._real[token] = a is None or (self.real(a) and self.real(b) and self._border(a, b, rank))
        return known

    def joins(self, a: int, b: int) -> bool:
        """Tokens a and b stay apart when encoded side by side."""
        key = a << 32 | b
        known = self.known_borders.get(key)
        if known is None:
            if len(self.known_borders) > BORDERS:
                self.known_borders.clear()
            known = self.known_borders[key] = self._border(a, b, NEVER)
        return known


class Trie:
    """Distinct byte strings in order, each with the length of the beginning it shares with the one
    before: a trie in depth-first order, whose nodes are the bytes that are not shared."""

    def __init__(self, words):
        self.words = sorted(words)
        self.shared = [0, *map(_shared, self.words, self.words[1:])]

    def nodes(self) -> int:
        return sum(map(len, self.words)) - sum(self.shared)


def _shared(a: bytes, b: bytes) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            return n
        n += 1
    return n


def encode_words(words, vocab: Vocabulary) -> dict[bytes, bytes]:
    """The tokens (int32) of each of the distinct, non-empty ``words``, by one walk of their trie."""
    trie = Trie(words)
    step, longest, shorter, borders, size, pack = vocab.step.get, vocab.longest, vocab.shorter, vocab.known_borders.get, vocab.size, vocab.packed
    where, last, found = [0], [], {}                 # at each depth of the path: its state; the last token of its encoding
    for word, shared in zip(trie.words, trie.shared):
        del where[shared + 1:], last[shared:]
        state = where[-1]
        for depth, byte in enumerate(word[shared:], shared + 1):
            after = step(state << 8 | byte)
            state = vocab.enter(state, byte) if after is None else after
            where.append(state)
            t = longest[state]
            while size[t] < depth:                   # tokens that end here, the longest first
                before = last[depth - size[t] - 1]
                fits = borders(before << 32 | t)
                if fits or (fits is None and vocab.joins(before, t)):
                    break
                t = shorter[t]
            last.append(t)
        tokens, at = [], len(word)
        while at:
            t = last[at - 1]
            tokens.append(pack[t])
            at -= size[t]
        tokens.reverse()
        found[word] = b"".join(tokens)
    return found


@cache
def newer_characters() -> list[tuple[int, int]]:
    """Ranges of letters and numbers to the regex library that the Unicode version of the
    tokenizers (Python's own) does not know; they count as symbols."""
    known, ranges = regex.compile(r"[\p{L}\p{N}]"), []
    for code in chain(range(0xD800), range(0xE000, sys.maxunicode + 1)):
        if unicodedata.category(chr(code)) == "Cn" and known.match(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1] = (ranges[-1][0], code)
            else:
                ranges.append((code, code))
    return ranges


class Splitter:
    """Cuts texts into pre-tokens."""

    def __init__(self):
        self.find = regex.compile(PATTERN).findall
        self.spans = regex.compile(PATTERN).finditer
        newer = newer_characters()
        # Python's own re holds such a class as a table
        self.newer = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in newer) + "]") if newer else None
        self.cut = regex.compile(r"(?<=\S) (?=\S)")

    def parts(self, text: str):
        """The text in parts of about LONG code points, between which no pre-token lies."""
        at = 0
        while len(text) - at > LONG:
            gap = self.cut.search(text, at + LONG)
            if gap is None:
                break
            yield text[at:gap.start()]
            at = gap.start()
        yield text[at:] if at else text

    def words(self, text: str) -> list[str]:
        if self.newer is None or text.isascii() or not self.newer.search(text):
            return self.find(text)
        return [text[m.start():m.end()] for m in self.spans(self.newer.sub(STAND_IN, text))]


class Encoder:
    """Encodes texts, keeping the encodings of words it has met: up to ``known`` words that came
    last, in a newer and an older half."""

    def __init__(self, vocab: Vocabulary, known: int = KNOWN):
        vocab.link()
        self.vocab, self.limit, self.known, self.older, self.split = vocab, known, {}, {}, Splitter()
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) + ")") if vocab.special else None
        self.special = {s: i.to_bytes(4, sys.byteorder) for s, i in vocab.special.items()}

    def ids(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """Tokens of the texts, one after another, and the number of each text's."""
        flat, sizes, held, letters = [], [], [], 0
        for text in texts:
            sizes.append(0)
            for k, piece in enumerate(self.marks.split(text) if self.marks else [text]):
                if k % 2:
                    held.append((len(sizes) - 1, [piece]))
                    continue
                for part in self.split.parts(piece):
                    held.append((len(sizes) - 1, self.split.words(part)))
                    letters += len(part)
                    if letters > 2 * LONG:
                        self._hand_over(held, flat, sizes)
                        held, letters = [], 0
        self._hand_over(held, flat, sizes)
        return np.frombuffer(b"".join(flat), dtype=np.int32), sizes

    def _hand_over(self, held: list, flat: list, sizes: list) -> None:
        """Put the new words of many texts into one trie, then look all words up."""
        self._learn(set().union(*(words for _, words in held)))
        for text, words in held:
            tokens = b"".join(map(self.known.__getitem__, words))
            flat.append(tokens)
            sizes[text] += len(tokens) // 4

    def _learn(self, words: set) -> None:
        if len(self.known) > self.limit // 2:
            self.known, self.older = {}, self.known
        self.known.update(self.special)
        fresh = words.difference(self.known)
        again = fresh.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        fresh = {w: w.encode() for w in fresh.difference(again)}
        tokens = encode_words(fresh.values(), self.vocab)
        self.known.update((w, tokens[b]) for w, b in fresh.items())


_LAST: list = []             # the vocabulary a Python worker read last, for the tasks that follow


def _loaded(text: str) -> Vocabulary:
    if not _LAST or _LAST[0] != text:
        _LAST[:] = [text, Vocabulary(text)]
    return _LAST[1]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, ids): the tokens of every row's text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocab_path))
    rows = docs.select(F.col(id_col), F.col(text))
    schema = T.StructType([rows.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def work(batches):
        encoder = Encoder(_loaded(shared.value))
        for batch in batches:
            data, offs, _ = W.text_buffers(batch.column(1))
            for lo, hi in W.pieces(offs):
                flat, sizes = encoder.ids([data[offs[k]:offs[k + 1]].tobytes().decode() for k in range(lo, hi)])
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), lists], names=schema.names)

    return rows.mapInArrow(work, schema)


def decode(encoded: DataFrame, vocab_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its tokens."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocab_path))
    rows = encoded.select(*[c for c in encoded.columns if c != into])
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())])

    def work(batches):
        vocab = _loaded(shared.value)
        text = {**vocab.bytes, **{i: s.encode() for s, i in vocab.special.items()}}
        size = np.zeros(max(text) + 2, dtype=np.int64)                   # the last one: ids outside the vocabulary
        for i, b in text.items():
            size[i] = len(b)
        start = np.cumsum(size) - size
        store = np.frombuffer(b"".join(text.get(i, b"") for i in range(len(size))), dtype=np.uint8)
        for batch in batches:
            column = batch.column(at)
            bounds = np.asarray(column.offsets).astype(np.int64)
            values = column.values.to_numpy(zero_copy_only=False)
            for lo, hi in W.pieces(bounds, W.PIECE // 4):
                own = values[bounds[lo]:bounds[hi]].astype(np.int64)
                own = np.where((own < 0) | (own >= len(size)), len(size) - 1, own)
                n = size[own]
                ends = np.cumsum(n)
                joined = store[np.repeat(start[own] - (ends - n), n) + np.arange(n.sum())].tobytes()
                cuts = np.concatenate([[0], ends])[bounds[lo:hi + 1] - bounds[lo]]
                out = [joined[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.record_batch([*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(out, pa.string())], names=schema.names)

    return rows.mapInArrow(work, schema)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    back = decode(encode(docs, path), path)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
