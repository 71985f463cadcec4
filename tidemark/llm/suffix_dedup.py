"""Removal of repeated byte strings by suffix arrays (operator 2).

A string of ``length`` bytes that also starts earlier in the corpus is removed.
Whole texts never meet in one place:

1. Every window of ``length`` bytes has an anchor, its least-hashed 32-byte
   gram, which depends on its bytes only. The windows that share an anchor are
   one context (at most 168 bytes of text); equal windows have equal anchors.
   Contexts go to shards by the anchor's hash. Of equal contexts all but the
   first are repeats at once (also before the shuffle, within a batch), and an
   anchor with one context in the corpus is done.
2. What is left, the different contexts of one anchor, forms the text of a
   shard: its suffix array (Larsson-Sadakane refinement), the common prefixes
   (Kasai) and the runs of common prefixes of ``length`` and more give the equal
   windows. Contexts of one anchor that go over two shards are merged by
   binary search of one shard's windows in the other's suffix array. An anchor
   with more text than a shard does not get there: its windows are dealt by
   their own hashes, as windows that differ have nothing to do with each other.
3. The removed ranges are joined to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import each_group, python_batches, stage
from tidemark.llm.shingles import _BASE, _BYTE, _powers, mix

#: Bytes of an anchor's gram.
GRAM = 32
#: Bytes of text in a shard, and of texts taken together while anchors are found.
SHARD, PIECE = 1 << 20, 1 << 19
#: Documents, and places or ranges with them, up to which lists are broadcast (under 100 MB); beyond, texts are shuffled.
BROADCAST_ROWS, BROADCAST_PLACES = 200_000, 2_000_000
_U = np.uint64


# ---- suffix arrays -------------------------------------------------------------------------------

def words8(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (zeros behind the end)."""
    out = np.concatenate([t, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    for s in (1, 2, 4):
        out[:-s] = (out[:-s] << _U(8 * s)) | out[s:]
        out[-s:] <<= _U(8 * s)
    return out[:len(t)]


def suffix_array(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``t`` in order, and each suffix's place in it.

    Larsson-Sadakane: sorted by eight bytes first; then only the groups of
    suffixes that are still equal are refined by the rank of what follows
    them, which doubles the sorted length each time.
    """
    n = len(t)
    first = words8(t)
    sa = np.argsort(first, kind="stable")
    key = first[sa]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.flatnonzero(new)[np.cumsum(new) - 1]
    h = 8
    while True:
        single = new & np.concatenate([new[1:], [True]])
        slots = np.flatnonzero(~single)
        if not len(slots):
            break
        s = sa[slots]
        # what has ended comes first, the shorter before the longer
        after = np.where(s + h < n, rank[np.minimum(s + h, n - 1)] + 1, np.maximum(n - s - h, -n))
        both = rank[s] * np.int64(2 * n + 2) + after + n
        order = np.argsort(both, kind="stable")
        s, both = s[order], both[order]
        sa[slots] = s
        change = np.concatenate([[True], both[1:] != both[:-1]])
        new[slots] = change
        rank[s] = slots[np.flatnonzero(change)[np.cumsum(change) - 1]]
        h *= 2
    place = np.empty(n, dtype=np.int64)
    place[sa] = np.arange(n)
    return sa, place


def common_prefixes(t: np.ndarray, sa: np.ndarray, place: np.ndarray, most: int, lanes: int = 4096) -> np.ndarray:
    """Length (at most ``most``) of the common prefix of each suffix in ``sa`` and the one before it.

    Kasai: going through the text, the prefix of the next suffix is at least
    the last one's less one. The text is cut into lanes that advance together.
    """
    n = len(t)
    padded = np.concatenate([t, np.zeros(most + 8, dtype=np.uint8)])
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, dtype=np.int64)
    lanes = min(lanes, n)
    width = -(-n // lanes)
    starts = np.arange(lanes) * width
    l = np.zeros(lanes, dtype=np.int64)
    for step in range(width):
        s = starts + step
        live = np.flatnonzero(s < n)
        at = s[live]
        l[live] = np.maximum(l[live] - 1, 0)
        other = before[at]
        l[live[other < 0]] = 0
        live, at, other = live[other >= 0], at[other >= 0], other[other >= 0]
        here = live
        while len(here):
            have = l[here]
            more = ((have < most) & (np.maximum(at, other) + have < n) & (padded[at + have] == padded[other + have]))
            here, at, other = here[more], at[more], other[more]
            l[here] += 1
        out[s[live]] = l[live]
    return out[sa]


class _Shard:
    """Contexts of some anchors: their windows' groups of equal strings, and which windows are repeats."""

    def __init__(self, rows: list[tuple], length: int):
        self.length = length
        sizes = np.array([len(r[3]) for r in rows])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.anchor = np.array([r[0] for r in rows], dtype=np.int64)
        self.doc = np.array([r[1] for r in rows], dtype=np.int64)
        self.low = np.array([r[2] for r in rows], dtype=np.int64)
        self.t = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8)
        n = len(self.t)
        self.row = np.repeat(np.arange(len(rows)), sizes)
        inside = np.arange(n) - self.starts[self.row]
        valid = inside + length <= sizes[self.row]
        sa, place = suffix_array(self.t)
        equal = common_prefixes(self.t, sa, place, length) >= length
        group = np.cumsum(~equal)
        keep = valid[sa]
        sa, group = sa[keep], group[keep]
        r = self.row[sa]
        # in each group the first by document and place stays
        order = np.lexsort((self.low[r] + inside[sa], self.doc[r], group))
        sa, group = sa[order], group[order]
        head = np.concatenate([[True], group[1:] != group[:-1]])
        self.repeat = np.zeros(n, dtype=bool)
        self.repeat[sa[~head]] = True
        self.unique = sa[head]          # in the order of their strings
        self.words = None

    def where(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = self.row[at]
        return self.doc[r], self.low[r] + at - self.starts[r]

    def of_anchor(self, anchor: int) -> np.ndarray:
        return self.unique[self.anchor[self.row[self.unique]] == anchor]

    def word(self, at: np.ndarray, k: int) -> np.ndarray:
        if self.words is None:
            self.words = words8(self.t)
        return self.words[at + min(8 * k, self.length - 8)]

    def merge(self, other: "_Shard", anchor: int) -> None:
        """Binary search of this shard's strings of ``anchor`` in the other's; the later one of two equal is a repeat."""
        mine, theirs = self.of_anchor(anchor), other.of_anchor(anchor)
        if not len(mine) or not len(theirs):
            return
        lo, hi = np.zeros(len(mine), dtype=np.int64), np.full(len(mine), len(theirs), dtype=np.int64)
        n_words = -(-self.length // 8)
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(theirs) - 1)
            less = self._compare(mine, other, theirs[mid], n_words) > 0
            lo, hi = np.where((lo < hi) & less, mid + 1, lo), np.where((lo < hi) & ~less, mid, hi)
        found = lo < len(theirs)
        same = found.copy()
        same[found] = self._compare(mine[found], other, theirs[lo[found]], n_words) == 0
        a, b = mine[same], theirs[lo[same]]
        (d1, p1), (d2, p2) = self.where(a), other.where(b)
        later = (d1 > d2) | ((d1 == d2) & (p1 > p2))
        self.repeat[a[later]] = True
        other.repeat[b[~later & ((d1 != d2) | (p1 != p2))]] = True

    def _compare(self, mine: np.ndarray, other: "_Shard", theirs: np.ndarray, n_words: int) -> np.ndarray:
        out = np.zeros(len(mine), dtype=np.int8)
        open_ = np.arange(len(mine))
        for k in range(n_words):
            x, y = self.word(mine[open_], k), other.word(theirs[open_], k)
            out[open_] = (x > y).astype(np.int8) - (x < y).astype(np.int8)
            open_ = open_[x == y]
            if not len(open_):
                break
        return out

    def ranges(self) -> pd.DataFrame:
        """Removed ranges (doc, start, end) of the repeated windows."""
        at = np.flatnonzero(self.repeat)
        if not len(at):
            return _ranges([], [], [])
        r = self.row[at]
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (r[1:] != r[:-1])])
        first, last = at[new], at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]
        doc, start = self.where(first)
        return _ranges(doc, start, start + (last - first) + self.length)


def _ranges(doc, start, end) -> pd.DataFrame:
    return pd.DataFrame({"doc": np.asarray(doc, dtype=np.int64), "start": np.asarray(start, dtype=np.int64),
                         "end": np.asarray(end, dtype=np.int64)})


# ---- anchors -------------------------------------------------------------------------------------

def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (leftmost of equals) of each ``width`` neighbouring hashes."""
    value, at, have = h, np.arange(len(h), dtype=np.int32), 1
    while have < width:
        s = min(have, width - have)
        left = value[:-s] <= value[s:]
        at = np.where(left, at[:-s], at[s:])
        value = np.minimum(value[:-s], value[s:])
        have += s
    return at


def anchors(texts: list[bytes], docs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Contexts of each text: anchor hash, context hash, document, first window, number of windows less one."""
    t = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(t)
    empty = np.zeros(0, dtype=np.int64)
    if n < length:
        return (empty,) * 5
    h = _BYTE[t]
    for s in (1, 2, 4, 8, 16):
        h = h[:-s] * _U(0x9E3779B97F4A7C15 + 2 * s) + (h[s:] ^ (h[s:] >> _U(29)))
    h = mix(h)
    least = _least(h, length - GRAM + 1)
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    row = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    p = np.flatnonzero(np.arange(len(least)) + length <= ends[row])
    if not len(p):
        return (empty,) * 5
    q, r = least[p], row[p]
    new = np.concatenate([[True], (q[1:] != q[:-1]) | (r[1:] != r[:-1])])
    at = np.flatnonzero(new)
    low, high, anchor, r = p[at], p[np.append(at[1:], len(p)) - 1], q[at], r[at]
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[t] * _powers(_BASE, n))])
    context = (sums[high + length] - sums[low]) * _powers(pow(_BASE, -1, 1 << 64), n)[low]
    context = mix(context + (anchor - low).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
                  + (high - low).astype(np.uint64) * _U(0xA0761D6478BD642F))
    return h[anchor].astype(np.int64), context.astype(np.int64), docs[r], low - begins[r], high - low


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _groups(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    k = 0
    while k < len(texts):
        end, total = k, 0
        while end < len(texts) and (end == k or total + len(texts[end]) <= most):
            total += len(texts[end])
            end += 1
        yield k, end
        k = end


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """fp, ch, doc, low, span, repeat: contexts; within a batch, equal ones after the first are marked."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = _utf8(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            parts = [anchors(texts[a:b], ids[a:b], length) for a, b in _groups(texts, PIECE)]
            if not parts:
                continue
            fp, ch, doc, low, span = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((low, doc, ch, fp))
            fp, ch, doc, low, span = (x[order] for x in (fp, ch, doc, low, span))
            again = np.zeros(len(fp), dtype=bool)
            again[1:] = (fp[1:] == fp[:-1]) & (ch[1:] == ch[:-1])
            # an equal place (repeated rows of one document) is no earlier place
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(fp))))
            again &= (doc != doc[first]) | (low != low[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp), pa.array(ch), pa.array(doc), pa.array(low.astype(np.int64)),
                 pa.array(span.astype(np.int32)), pa.array(again)], ["fp", "ch", "doc", "low", "span", "again"])

    return docs.mapInArrow(find, "fp long, ch long, doc long, low long, span int, again boolean")


def _first_of_equals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by fp, ch, doc, low. Repeats of a context, and the first ones of anchors with several (kind 1)."""
    held: pd.DataFrame | None = None        # the last first-of-its-kind, not yet known to be alone
    known = False                           # its anchor has had another context before
    for batch in batches:
        b = batch if held is None else pd.concat([held, batch], ignore_index=True)
        fp, ch, doc, low = (b[c].to_numpy() for c in ("fp", "ch", "doc", "low"))
        new = np.concatenate([[True], (fp[1:] != fp[:-1]) | (ch[1:] != ch[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(b)), 0))
        again = ~new & ((doc != doc[first]) | (low != low[first]))
        heads = np.flatnonzero(new)
        same = fp[heads[1:]] == fp[heads[:-1]]
        several = np.concatenate([[known], same]) | np.concatenate([same, [False]])
        out = b[again].assign(kind=0)
        done = heads[:-1][several[:-1]]
        known = bool(several[-1])
        held = b.iloc[[heads[-1]]]
        yield pd.concat([out, b.iloc[done].assign(kind=1)])[["fp", "doc", "low", "span", "kind"]]
    if held is not None and known:
        yield held.assign(kind=1)[["fp", "doc", "low", "span", "kind"]]


def _shard_ranges(rows: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Removed ranges from contexts sorted by fp: shards of bounded text, those that an anchor spans merged."""
    spanning: list[_Shard] = []             # shards that hold the anchor at the end of the last one
    last = None

    def close(part: list[tuple]) -> Iterator[pd.DataFrame]:
        nonlocal spanning, last
        shard, first = _Shard(part, length), part[0][0]
        if spanning and first == last:
            for other in spanning:
                shard.merge(other, first)
            if part[-1][0] == first:        # the anchor may go on
                spanning.append(shard)
                return
        for other in spanning:
            yield other.ranges()
        spanning, last = [shard], part[-1][0]

    part, size = [], 0
    for batch in rows:
        for row in zip(batch["fp"], batch["doc"], batch["low"], batch["context"]):
            part.append(row)
            size += len(row[3])
            if size >= SHARD:
                yield from close(part)
                part, size = [], 0
    if part:
        yield from close(part)
    for other in spanning:
        yield other.ranges()


def _merge_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Maximal ranges of each document from ranges sorted by document and start."""
    for g in each_group(batches, ["doc"]):
        start, end = g["start"], np.maximum.accumulate(g["end"])
        new = np.concatenate([[True], start[1:] > end[:-1]])
        at = np.flatnonzero(new)
        yield _ranges(np.full(len(at), g["doc"][0]), start[at], end[np.append(at[1:], len(start)) - 1])


def _together(frames: Iterator[pd.DataFrame], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for f in frames:
        held.append(f)
        size += len(f)
        if size >= rows:
            yield pd.concat(held)
            held, size = [], 0
    if held:
        yield pd.concat(held)


def _few(lists: DataFrame, column: str) -> bool:
    size = lists.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(column)).alias("items")).first()
    return size["n"] <= BROADCAST_ROWS and (size["items"] or 0) <= BROADCAST_PLACES


def _window_repeats(texts: DataFrame, length: int) -> DataFrame:
    """doc, low, span (0) of the windows of contexts (fp, doc, low, context) that also start earlier.

    A window goes by its hashes (128 bits beside the anchor's), so no task holds an anchor.
    """
    windows = texts.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("context") - F.lit(length))))
    windows = windows.withColumn("w", F.expr(f"substring(context, i + 1, {length})")).select(
        "fp", "doc", (F.col("low") + F.col("i")).alias("low"), F.xxhash64("w").alias("a"), F.xxhash64(F.lit(1), "w").alias("b"))
    windows = stage(windows, "windows")
    firsts = windows.groupBy("fp", "a", "b").agg(F.min(F.struct("doc", "low")).alias("first"), F.count(F.lit(1)).alias("n"))
    again = windows.join(firsts.where("n > 1"), ["fp", "a", "b"]).where("doc != first.doc or low != first.low")
    return again.select("doc", "low", F.lit(0).alias("span"))


def repeated_ranges(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc, start, end: maximal ranges of bytes of ``docs`` (doc, text; one row a doc) to remove."""
    spark = docs.sparkSession
    python_batches(spark)
    found = stage(_contexts(docs, length), "contexts")
    span_end = F.col("low") + F.col("span") + F.lit(length)
    python_batches(spark, 20_000)
    firsts = (found.where("not again").select("fp", "ch", "doc", "low", "span").repartition("fp")
              .sortWithinPartitions("fp", "ch", "doc", "low"))
    judged = stage(firsts.mapInPandas(_first_of_equals, "fp long, doc long, low long, span int, kind int"), "judged")
    at_once = found.where("again").select("doc", "low", "span").unionByName(
        judged.where("kind = 0").select("doc", "low", "span"))

    # anchors whose contexts are more than a shard holds: at most one for each shard of text
    several = judged.where("kind = 1").select("fp", "doc", "low", "span")
    heavy = stage(several.groupBy("fp").agg(F.sum(F.col("span") + F.lit(length)).alias("size"))
                  .where(F.col("size") > SHARD).select("fp"), "heavy-anchors")
    n_heavy = heavy.count()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, doc, low, context = [], [], [], []
            for d, t, at in zip(batch.column(0).to_pylist(), _utf8(batch.column(1)), batch.column(2).to_pylist()):
                for x in at:
                    fp.append(x["fp"])
                    doc.append(d)
                    low.append(x["low"])
                    context.append(t[x["low"]:x["low"] + x["span"] + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp, pa.int64()), pa.array(doc, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(context, pa.binary())], ["fp", "doc", "low", "context"])

    def contexts(rows: DataFrame) -> DataFrame:
        places = stage(rows.groupBy("doc").agg(F.collect_list(F.struct("fp", "low", "span")).alias("at")), "places")
        python_batches(spark, 500)
        few = _few(places, "at")
        held = docs.join(F.broadcast(places) if few else places.hint("shuffle_hash"), "doc").select("doc", "text", "at")
        return held.mapInArrow(cut, "fp long, doc long, low long, context binary")

    if n_heavy:
        listed = F.broadcast(heavy) if n_heavy <= BROADCAST_ROWS else heavy
        at_once = at_once.unionByName(_window_repeats(contexts(several.join(listed, "fp", "left_semi")), length))
        several = several.join(listed, "fp", "left_anti")
    texts = contexts(several).repartition("fp").sortWithinPartitions("fp", "doc", "low")

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _together(_shard_ranges(batches, length))

    python_batches(spark, 10_000)
    merged = texts.mapInPandas(shards, "doc long, start long, end long")
    ranges = at_once.select("doc", F.col("low").alias("start"), span_end.alias("end")).unionByName(merged).distinct()
    ranges = ranges.repartition("doc").sortWithinPartitions("doc", "start", "end")

    def maximal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _together(_merge_ranges(batches))

    return stage(ranges.mapInPandas(maximal, "doc long, start long, end long"), "ranges")


def remove_repeats(docs: DataFrame, length: int = 100, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes) of each row of ``docs``.

    Removed is every byte covered by a ``length``-byte string that also starts
    earlier: in a document of smaller doc_id, or in the same at an earlier
    start; overlaps count, and the input is what is judged. A null text is
    empty, a null id sorts first. Rows of one doc_id and one text are one
    document, each with the same result; several texts of one doc_id go by the
    text's hash. Other columns are not read; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    unique = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("u")).first()
    if unique["n"] == unique["u"]:
        docs = docs.withColumn("doc", F.col("doc_id"))
        single = docs
    else:
        docs = _numbered(docs)
        single = docs.dropDuplicates(["doc"])
    ranges = repeated_ranges(single.select("doc", "text"), length)
    lists = stage(ranges.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cut")), "cuts")
    few = _few(lists, "cut")
    both = docs.join(F.broadcast(lists) if few else lists.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "cut")
    python_batches(spark, 500)

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, spans, digest, kept = [], [], [], [], []
            for t, cuts in zip(_utf8(batch.column(1)), batch.column(2).to_pylist()):
                rest, at, removed = [], 0, 0
                for c in cuts or ():
                    rest.append(t[at:c["start"]])
                    removed += c["end"] - c["start"]
                    at = c["end"]
                rest = b"".join(rest) + t[at:]
                n.append(len(t))
                gone.append(removed)
                spans.append(len(cuts or ()))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                    pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                cols, names = cols + [pa.array(kept, pa.binary())], names + ["kept"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return both.mapInArrow(result, schema + (", kept binary" if with_bytes else ""))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc``: a number in the order of doc_id (null first) and the text's hash, equal for equal rows."""
    docs = docs.withColumn("_k", F.xxhash64("text"))
    keys = stage(docs.select("doc_id", "_k").distinct().orderBy(F.asc_nulls_first("doc_id"), "_k")
                 .select("doc_id", "_k", F.spark_partition_id().alias("part"),
                         F.monotonically_increasing_id().alias("at")), "doc-keys")
    # a number before each partition, one row per partition
    sizes = {r["part"]: r["n"] for r in keys.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = {}, 0
    for part in sorted(sizes):
        offsets[part] = total
        total += sizes[part]
    if not offsets:
        return docs.withColumn("doc", F.lit(0).cast("long")).drop("_k")
    shift = F.create_map(*[F.lit(x) for p, o in offsets.items() for x in (p, o - (p << 33))])
    keys = keys.select(F.col("doc_id").alias("_d"), F.col("_k").alias("_h"), (F.col("at") + shift[F.col("part")]).alias("doc"))
    return docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("_k").eqNullSafe(F.col("_h"))).select(
        "doc_id", "text", "doc")
