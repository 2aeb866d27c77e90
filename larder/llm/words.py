"""Words of many texts at once, as numpy arrays over Arrow buffers.

Words are runs of bytes outside a set of ASCII separators, which is the same as
runs of characters: in UTF-8 no byte of a longer character is ASCII. A word is
named by a 64-bit hash of its bytes, taken from prefix sums, so that no Python
string is made. Hashes of two sequences agree by chance about once in 2**58 pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

CHUNK = 1 << 18          # bytes hashed in one go
PIECE = 1 << 21          # bytes of texts handed out together

_U = np.uint64
_MASK = (1 << 64) - 1
P1, P2 = 0x9E3779B97F4A7C15 & ~7 | 3, 0xC2B2AE3D27D4EB4F & ~7 | 3   # 3 mod 8: powers differ in their low bits
_rng = np.random.default_rng(20240501)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * _U(pow(base, have, 1 << 64))
        have += more
    return out


class _Table:
    """Powers of an odd number and of its inverse, longer when asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 64, 2 * len(self.up))
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up, self.down


_BYTES, _WORDS, _WORDS2 = _Table(P1), _Table(P2), _Table(P1 ^ 0x5DEECE66D0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a hash over all bits."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@dataclass
class Words:
    """Words of consecutive texts: byte spans in ``data``, hashes, first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray     # len(texts) + 1

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.start))


def separator_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(separators)] = True
    return table


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, fold: bool) -> Words:
    """Words of the texts data[offsets[i]:offsets[i+1]]; ``fold`` lower-cases A-Z first."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    starts, ends, codes = [], [], []
    at = lo
    edges = offsets[1:-1]
    while at < hi:
        stop = min(at + CHUNK, hi)
        if stop < hi:          # cut at the last text start or separator, else go on to the next
            k = int(np.searchsorted(edges, stop, side="right")) - 1
            cut = int(edges[k]) if k >= 0 and edges[k] > at else at
            gaps = np.flatnonzero(separators[data[max(cut, at + 1):stop]])
            if len(gaps):
                cut = max(cut, at + 1) + int(gaps[-1])
            while cut <= at and stop < hi:
                ahead = min(stop + CHUNK, hi)
                gaps = np.flatnonzero(separators[data[stop:ahead]])
                k = int(np.searchsorted(edges, stop, side="left"))
                cut = min(stop + int(gaps[0]) if len(gaps) else hi + 1, int(edges[k]) if k < len(edges) else hi + 1)
                cut, stop = (at, ahead) if cut > ahead else (cut, cut)
            stop = cut if cut > at else hi
        part = data[at:stop]
        if fold:
            part = FOLD[part]
        inside = ~separators[part]
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[0] = after[-1] = False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        a, b = np.searchsorted(edges, [at, stop], side="left")
        inner = edges[a:b] - at
        inner = inner[inner < len(part)]
        before[inner] = False
        after[inner[inner > 0] - 1] = False
        s, e = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        up, down = _BYTES.get(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODE[part] * up[:len(part)], out=total[1:])
        codes.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    none = np.empty(0, dtype=np.int64)
    start = np.concatenate(starts) if starts else none
    end = np.concatenate(ends) if ends else none
    code = np.concatenate(codes) if codes else np.empty(0, dtype=np.uint64)
    return Words(data, start, end, code, np.searchsorted(start, offsets))


def sequence_codes(code: np.ndarray, begin: np.ndarray, length, second: bool = False) -> np.ndarray:
    """Hash of the words code[begin:begin+length] for every begin; ``second``: an independent one."""
    table = _WORDS2 if second else _WORDS
    up, down = table.get(len(code) + 1)
    total = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum((mix(code + _U(0x51ED27)) if second else code) * up[:len(code)], out=total[1:])
    return mix((total[begin + length] - total[begin]) * down[begin] + np.asarray(length).astype(np.uint64))


def codes_without(code: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the words code[begin:end] without the one at ``at``: what ``sequence_codes`` gives for the words left."""
    up, down = _WORDS.get(len(code) + 1)
    total = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum(code * up[:len(code)], out=total[1:])
    rest = (total[at] - total[begin]) * down[begin] + (total[end] - total[at + 1]) * down[begin + 1]
    return mix(rest + np.asarray(end - begin - 1).astype(np.uint64))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and validity of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.asarray(column.is_valid())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64), valid
    offs = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offs, valid


def pieces(offsets: np.ndarray, size: int = PIECE):
    """Ranges (lo, hi) of texts of about ``size`` bytes together; a longer text stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
