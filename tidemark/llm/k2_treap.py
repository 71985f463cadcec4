"""A K2-treap over a grid of terms (rows) and documents (columns), in numpy.

The grid is cut into strips of as many rows as it has columns (a power of two);
each strip is a quadtree of cells that hold a posting. A cell stores which of its
four quarters are not empty (four bits) and, as the difference to the cell above,
the greatest impact in it; a cell of one row and one column is the posting itself.
Children lie in the order of their parents, so places follow from counts of ones.

``best_first`` answers several weighted sets of rows at once. A document range of a
set is the cells that its rows pass through there; the weighted sum of their maxima
bounds every document's score. The ranges of greatest bound are halved first (every
row's path goes on into the half where its bits lead), until no range can reach the
k-th best score.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_HEAD = "<III"
_ONES = np.array([bin(x).count("1") for x in range(16)], dtype=np.int64)
_TYPES = ["<u1", "<u2", "<u4", "<u8"]


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of a number below 2**16 at every second place."""
    x = x.astype(np.uint64)
    for shift, mask in ((8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class K2Treap:
    """``bits`` levels below the strips; ``quarters`` of the inner cells and ``most`` of all cells, level by level."""

    def __init__(self, bits: int, strips: int, quarters: np.ndarray, most: np.ndarray):
        self.bits, self.strips, self.quarters, self.most = bits, strips, quarters, most
        ones = _ONES[quarters]
        self.child = strips + np.cumsum(ones) - ones     # place of a cell's first child

    @classmethod
    def build(cls, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, n_cols: int) -> K2Treap:
        """Of distinct points (row, column) with positive impacts; every row up to the last holds a point."""
        bits = max(1, int(n_cols - 1).bit_length())
        if bits > 16:
            raise ValueError("a grid has at most 65,536 columns")
        rows = rows.astype(np.int64)
        code = (rows >> bits).astype(np.uint64) << np.uint64(2 * bits)
        code |= _spread(rows & ((1 << bits) - 1)) << np.uint64(1) | _spread(cols)
        order = np.argsort(code, kind="stable")
        code, most = code[order], impacts[order].astype(np.int64)
        quarters, maxima = [], [most]
        for _ in range(bits):
            above = code >> np.uint64(2)
            begins = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
            quarters.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), begins))
            most = np.maximum.reduceat(most, begins)
            maxima.append(most)
            code = above[begins]
        return cls(bits, len(most), np.concatenate(quarters[::-1]), np.concatenate(maxima[::-1]))

    def _levels(self) -> list[tuple[int, int]]:
        """Begin and end of each level's cells."""
        out, a, b = [], 0, self.strips
        for _ in range(self.bits):
            out.append((a, b))
            a, b = b, b + int(_ONES[self.quarters[a:b]].sum())
        return [*out, (a, b)]

    def to_bytes(self) -> bytes:
        levels = self._levels()
        parts = [self.most[:self.strips].astype("<u8").tobytes()]
        for (a, b), (c, d) in zip(levels[:-1], levels[1:], strict=True):
            less = np.repeat(self.most[a:b], _ONES[self.quarters[a:b]]) - self.most[c:d]
            kind = next(k for k, t in enumerate(_TYPES) if int(less.max()) <= np.iinfo(t).max)
            parts += [bytes([kind]), less.astype(_TYPES[kind]).tobytes()]
        two = np.concatenate([self.quarters, np.zeros(len(self.quarters) % 2, np.uint8)]).reshape(-1, 2)
        data = struct.pack(_HEAD, self.bits, self.strips, len(self.quarters)) + (two[:, 0] | two[:, 1] << 4).tobytes()
        return zstandard.ZstdCompressor(level=3).compress(data + b"".join(parts))

    @classmethod
    def from_bytes(cls, data: bytes) -> K2Treap:
        data = zstandard.ZstdDecompressor().decompress(data)
        bits, strips, n = struct.unpack_from(_HEAD, data)
        at = struct.calcsize(_HEAD)
        two = np.frombuffer(data, np.uint8, (n + 1) // 2, at)
        quarters = np.stack([two & 15, two >> 4], axis=1).ravel()[:n]
        at += len(two)
        most = [np.frombuffer(data, "<u8", strips, at).astype(np.int64)]
        at += 8 * strips
        a, b = 0, strips
        for _ in range(bits):
            ones = _ONES[quarters[a:b]]
            a, b = b, b + int(ones.sum())
            kind = np.dtype(_TYPES[data[at]])
            most.append(np.repeat(most[-1], ones) - np.frombuffer(data, kind, b - a, at + 1).astype(np.int64))
            at += 1 + kind.itemsize * (b - a)
        return cls(bits, strips, quarters, np.concatenate(most))

    def values(self, row: int) -> dict[int, int]:
        """The row's postings (column: impact), walked down from its strip."""
        cells = [(row >> self.bits, 0)]
        for level in range(self.bits):
            half = (row >> (self.bits - 1 - level) & 1) * 2
            cells = [(int(self.child[c] + _ONES[self.quarters[c] & ((1 << half + x) - 1)]), lo * 2 + x)
                     for c, lo in cells for x in (0, 1) if self.quarters[c] >> (half + x) & 1]
        return {lo: int(self.most[c]) for c, lo in cells}


class _Grown:
    """Arrays that grow at the end."""

    def __init__(self, *types):
        self.n, self.arrays = 0, [np.empty(1024, dtype=t) for t in types]

    def add(self, *more: np.ndarray) -> int:
        """Where the new entries begin."""
        begin, self.n = self.n, self.n + len(more[0])
        if self.n > len(self.arrays[0]):
            self.arrays = [np.concatenate([a[:begin], np.empty(max(begin, self.n - begin), a.dtype)]) for a in self.arrays]
        for a, m in zip(self.arrays, more, strict=True):
            a[begin:self.n] = m
        return begin


def _keep_best(top: np.ndarray, query: np.ndarray, score: np.ndarray) -> None:
    """Put scores into the queries' rows of ``top``, which hold the best ones in descending order."""
    k = top.shape[1]
    touched, at = np.unique(query, return_inverse=True)
    q = np.concatenate([np.repeat(np.arange(len(touched)), k), at])
    s = np.concatenate([top[touched].ravel(), score])
    order = np.lexsort((-s, q))
    q, s = q[order], s[order]
    begins = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    rank = np.arange(len(q)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(q)]])))
    top[touched[q[rank < k]], rank[rank < k]] = s[rank < k]


def best_first(grid: K2Treap, query: np.ndarray, row: np.ndarray, weight: np.ndarray, top: np.ndarray,
               first: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, column and score of every document that may be among the best of a query.

    ``query`` (ascending), ``row`` and positive ``weight`` list the queries' rows; ``top`` (queries
    x k) holds the best scores found elsewhere, in descending order, and takes up those found
    here. Documents that tie with a k-th best score are returned. Each round halves the best
    ranges of every query, ``first`` of them at first and then twice as many each time.
    """
    nodes = _Grown(np.int64, np.int64)                       # cell, place in ``row``
    nodes.add(row >> grid.bits, np.arange(len(row)))
    begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
    ends = np.concatenate([begins[1:], [len(query)]]).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(weight * grid.most[row >> grid.bits])])
    # of a range: query, level, first column in units of its width, bound, its cells
    ranges = [query[begins], np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64), sums[ends] - sums[begins], begins, ends]
    found, take = [], first
    while len(ranges[0]):
        live = ranges[3] >= np.maximum(top[ranges[0], -1], 1)
        ranges = [x[live] for x in ranges]
        if not len(ranges[0]):
            break
        order = np.lexsort((-ranges[3], ranges[0]))
        q = ranges[0][order]
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(q)]])))
        chosen, rest = order[rank < take], order[rank >= take]
        take *= 2
        new = _halves(grid, nodes, row, weight, [x[chosen] for x in ranges])
        done = new[1] == grid.bits
        if done.any():
            found.append((new[0][done], new[2][done], new[3][done]))
            _keep_best(top, new[0][done], new[3][done])
        ranges = [np.concatenate([x[rest], y[~done]]) for x, y in zip(ranges, new, strict=True)]
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    query, col, score = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = score >= np.maximum(top[query, -1], 1)
    return query[keep], col[keep], score[keep]


def _halves(grid: K2Treap, nodes: _Grown, row: np.ndarray, weight: np.ndarray, ranges: list[np.ndarray]) -> list[np.ndarray]:
    """The two halves of each range, without empty ones."""
    query, level, low, _, begin, end = ranges
    size = end - begin
    of = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    cell, term = nodes.arrays[0][at], nodes.arrays[1][at]
    quarters = grid.quarters[cell].astype(np.int64)
    upper = (row[term] >> (grid.bits - 1 - level[of]) & 1) * 2
    out = []
    for half in (0, 1):
        place = upper + half
        there = (quarters >> place & 1).astype(bool)
        child = grid.child[cell[there]] + _ONES[quarters[there] & ((1 << place[there]) - 1)]
        n = np.bincount(of[there], minlength=len(size))
        ends = np.cumsum(n)
        sums = np.concatenate([[0], np.cumsum(weight[term[there]] * grid.most[child])])
        first = nodes.add(child, term[there])
        some = n > 0
        out.append([x[some] for x in (query, level + 1, low * 2 + half, sums[ends] - sums[ends - n], first + ends - n, first + ends)])
    return [np.concatenate(x) for x in zip(*out, strict=True)]
