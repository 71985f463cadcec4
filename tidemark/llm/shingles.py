"""Word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
#: Bytes that end a word: blank and \\x09-\\x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D          # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.full(size, base, dtype=np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word (run of bytes other than white space) of lower-cased ``text``."""
    a = np.frombuffer(text.lower(), dtype=np.uint8)      # bytes.lower changes A-Z only
    space = np.concatenate([[True], _SPACE[a], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    n = len(a)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[a] * _powers(_BASE, n))])
    back = _powers(pow(_BASE, -1, 1 << 64), n)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes], size: int = 5, piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """Of each text the sorted hashes of its distinct shingles of ``size`` words.

    Fewer words than that: the whole sequence as one; no word: none. Texts are
    taken together up to ``piece`` bytes, so that short ones cost little.
    """
    k = 0
    while k < len(texts):
        end, total = k, 0
        while end < len(texts) and (end == k or total + len(texts[end]) <= piece):
            total += len(texts[end]) + 1
            end += 1
        group = texts[k:end]
        words, starts = word_hashes(b" ".join(group))
        limits = np.cumsum([0] + [len(t) + 1 for t in group])
        at = np.searchsorted(starts, limits)
        n = len(words)
        factors = mix(np.arange(11, 11 + size, dtype=np.uint64))
        full = np.zeros(max(0, n - size + 1), dtype=np.uint64)
        for j in range(size):
            full += words[j:j + len(full)] * (factors[j] | _U(1))
        full = mix(full)
        for i in range(len(group)):
            a, b = at[i], at[i + 1]
            if b - a >= size:
                s = np.sort(full[a:b - size + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif b > a:
                own = (words[a:b] * (factors[:b - a] | _U(1))).sum(keepdims=True)
                yield mix(own + np.array([b - a], dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
            else:
                yield np.zeros(0, dtype=np.uint64)
        k = end
