"""Vectorised text pieces used inside tasks: bounded segments, hashed words and windows.

Word hashes are polynomial prefix sums modulo 2**64 over one concatenated buffer, so a
whole batch of documents is hashed with a handful of numpy passes instead of a Python
loop over words. Hashes depend on the word alone, never on process, batch or position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_BLOCK = 1 << 19
_U = np.uint64

_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(_BLOCK + 1, n + 1)
        out = []
        for base in (_R, _RINV):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > 8 * _BLOCK:  # a giant word: not worth keeping
            return out[0], out[1]
        _powers.update(n=size - 1, up=out[0], down=out[1])
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, on a uint64 array."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def values_of(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for each byte (uint8 input) or code point (uint32 input)."""
    if codes.dtype == np.uint8:
        return _BYTE_VALUE[codes]
    return mix((codes.astype(np.uint64) + _U(1)) * _U(0xD1342543DE82EF95))


def prefix_sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """S and the inverse powers: the hash of codes[a:b] is (S[b] - S[a]) * down[a]."""
    up, down = _power_tables(len(codes))
    s = np.empty(len(codes) + 1, dtype=np.uint64)
    s[0] = 0
    np.cumsum(values_of(codes) * up[: len(codes)], out=s[1:])
    return s, down


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the maximal runs of True."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    if len(inside) and inside[-1]:
        edge = np.concatenate((edge, [len(inside)]))
    return edge[::2], edge[1::2]


def hashed_words(codes: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash) of every maximal run of word characters in ``codes``.

    ``is_word`` is a boolean per position. Works block by block (cut between words), so
    temporary arrays stay small however long the buffer is.
    """
    starts, ends, hashes = [], [], []
    at, n = 0, len(codes)
    while at < n:
        end = min(at + _BLOCK, n)
        if end < n and is_word[end - 1] and is_word[end]:
            gaps = np.flatnonzero(~is_word[at:end])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a block
                while end < n and is_word[end]:
                    after = np.flatnonzero(~is_word[end:end + _BLOCK])
                    end = end + int(after[0]) if len(after) else min(end + _BLOCK, n)
        s, e = runs(is_word[at:end])
        if len(s):
            sums, down = prefix_sums(codes[at:end])
            h = (sums[e] - sums[s]) * down[s]
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(mix(h ^ (e - s).astype(np.uint64)))
        at = end
    if not starts:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def small_batches(batches, rows: int = 512):
    """Slices of record batches, so that few texts at a time become Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def segments(texts: list[str | None], limit: int) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of (document index, text) with about ``limit`` characters each.

    A text longer than the limit is cut into several segments (after white space where
    there is any in the last tenth); every character lies in exactly one of them.
    """
    idx: list[int] = []
    out: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        t = t or ""
        at = 0
        while True:
            if len(t) - at <= limit:
                part, at = t[at:] if at else t, len(t)
            else:
                cut = max(t.rfind(" ", at + limit - limit // 10, at + limit),
                          t.rfind("\n", at + limit - limit // 10, at + limit)) + 1
                cut = cut if cut > at else at + limit
                part, at = t[at:cut], cut
            if size and size + len(part) > limit:
                yield idx, out
                idx, out, size = [], [], 0
            idx.append(i)
            out.append(part)
            size += len(part) + 1
            if at >= len(t):
                break
    if out:
        yield idx, out


#: The white space of the contracts: space and \t \n \v \f \r.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def code_points(parts: list[str]) -> np.ndarray:
    """The parts joined by line feeds (one after each), as uint32 code points."""
    joined = "\n".join(parts) + "\n"
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
