"""Cross-tokenizer alignment (operator 13): which tokens of two tokenizers cover the same bytes, and how often.

Byte places where tokens of both end cut a text into groups; every pair of tokens
of one group is a link. How many documents hold a pair linked is counted over the
corpus: tasks align their documents and keep their distinct pairs with numbers of
documents; the distinct pairs of each of ``SEGMENTS`` segments (by a hash) get a
minimal perfect hash; each task's numbers become a dense vector that the hash
indexes, and vectors are added up in a tree. The stored pair at a hash's place
verifies it. A second pass aligns the documents again and looks the counts up.

Texts are cut at blanks that no token of either tokenizer goes over, so a cut is
aligned alone and remembered by the worker.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import python_batches, stage
from tidemark.llm.perfect_hash import PerfectHash, mixed
from tidemark.llm.token_ids import MARKS, IdEncoder, Memory, distinct_parts, joined, slices

#: Segments of the distinct pairs. A pair is two ids, so a segment holds at most |A| x |B| / 256 pairs
#: (6.3 million for vocabularies of 50,257 and 32,000).
SEGMENTS = 256
#: Distinct pairs that a task holds before it puts them out.
HELD_PAIRS = 4_000_000
#: Vectors that are added up in one task of the tree.
FAN_IN = 16
#: Parts that a generation of a worker's memory holds in the first and in the second pass.
PAIRS_REMEMBERED, REMEMBERED = 600_000, 300_000
#: Characters that are aligned at once.
AT_ONCE = 1_500_000
#: Bytes of pairs and counts up to which the second pass has them in its tasks; beyond, it joins them.
BROADCAST_BYTES = 96_000_000


# one text
def byte_of_character() -> dict[str, int]:
    """The bytes that the characters of byte-level entries stand for: printable Latin-1 for itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


class Aligner:
    """Aligns texts by a byte-level file of ``tokenizers`` (A) and a ``sentencepiece`` model (B)."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.a = IdEncoder(path_a, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        proto = pb.ModelProto()
        with open(path_b, "rb") as f:
            proto.ParseFromString(f.read())
        norm, trained = proto.normalizer_spec, proto.trainer_spec
        # a cut may be encoded alone where no piece goes on over a blank and blanks are kept as they are
        self.by_parts = (self.a.by_parts and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
                         and norm.escape_whitespaces and norm.add_dummy_prefix and not trained.treat_whitespace_as_suffix
                         and trained.model_type == trained.BPE
                         and not any("▁" in p.piece.lstrip("▁") for p in proto.pieces))
        chars = byte_of_character()
        vocab = self.a.tokenizer.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        byte = pb.ModelProto.SentencePiece.BYTE
        self.bytes_b = [bytes([int(p.piece[3:-1], 16)]) if p.type == byte else p.piece.replace("▁", " ").encode()
                        for p in proto.pieces]
        self.n_b = len(self.bytes_b)
        self.size_a, self.size_b = np.array([len(x) for x in self.bytes_a]), np.array([len(x) for x in self.bytes_b])
        self.kind = "<u4" if len(self.bytes_a) * self.n_b < 2**32 else "<u8"
        self.words = [[f"{i}{c}" for i in range(max(len(self.bytes_a), self.n_b))] for c in ",|;"]
        # a mark behind a word is a part of its own where no piece goes on from a letter to a mark
        self.marks = "" if any(x[-1:].isalpha() for p in proto.pieces for m in MARKS for x in p.piece.split(m)[:-1]) else MARKS

    def parts(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``distinct_parts`` of the texts; an empty one has none."""
        if self.by_parts:
            parts, of, offsets = distinct_parts(texts)
        else:
            number: dict[str, int] = {}
            of = np.array([number.setdefault(t, len(number)) for t in texts], dtype=np.int64)
            parts, offsets = list(number), np.arange(len(texts) + 1)
        if "" in parts:
            kept = of != parts.index("")
            of, offsets = of[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]
        return parts, of, offsets

    def aligned(self, parts: list[str]) -> Aligned | None:
        """All parts (a blank stands before each) as one text to both; None if one of them is not to come back byte for byte."""
        data = "".join([" " + p for p in parts]).encode()
        stops = np.cumsum([len(p.encode()) + 1 for p in parts])
        a = np.frombuffer(self.a.whole([" " + " ".join(parts)])[0], dtype="<u4").astype(np.int64)
        b = np.array(self.b.encode(" ".join(parts)), dtype=np.int64)
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != data or b"".join([self.bytes_b[i] for i in b.tolist()]) != data:
            return None
        found = Aligned(a, b, np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), stops)
        return found if found.cuts_at_stops else None

    def mark(self, mark: str, make):
        """``make`` of a mark that follows a letter: no blank stands before it."""
        a = np.frombuffer(self.a.whole([mark])[0], dtype="<u4").astype(np.int64)
        b = np.array(self.b.encode("a" + mark)[1:], dtype=np.int64)
        if not len(b) or b"".join([self.bytes_a[i] for i in a]) != mark.encode() or b"".join([self.bytes_b[i] for i in b]) != mark.encode():
            return None
        return make(Aligned(a, b, np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.array([len(mark)])))[0]

    def each(self, parts: list[str], make) -> list:
        """``make`` of alignments, for each part: many parts at once, odd ones alone; None for those without tokens."""
        out: list = [None] * len(parts)
        plain = [k for k, p in enumerate(parts) if self.by_parts and p and not p[0].isspace() and p[-1] != " " and "\u2581" not in p]
        done = self.aligned([parts[k] for k in plain]) if plain else None
        if done is not None:
            for k, x in zip(plain, make(done), strict=True):
                out[k] = x
        alone = set(range(len(parts))) if done is None else set(range(len(parts))) - set(plain)
        for k in alone:
            one = self.aligned([parts[k]])
            if one is not None:
                out[k] = make(one)[0]
        return out


class Aligned:
    """Tokens of A and B over the same bytes, cut into groups where both end and into parts at ``stops``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, stops: np.ndarray):
        self.a, self.b = a, b
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.of_a, self.of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)       # groups
        self.n_a, self.n_b = np.bincount(self.of_a, minlength=len(cuts)), np.bincount(self.of_b, minlength=len(cuts))
        self.first_b = np.cumsum(self.n_b) - self.n_b
        self.last = np.searchsorted(cuts, stops)                    # last group of each part
        self.cuts_at_stops = bool((self.last < len(cuts)).all() and np.array_equal(cuts[self.last], stops))

    def per_part(self, of_groups: np.ndarray) -> np.ndarray:
        sums = np.cumsum(of_groups)[self.last]
        return np.diff(sums, prepend=0)

    def counts(self) -> list[list[int]]:
        """Of each part: tokens of A, of B, groups, links."""
        return [self.per_part(x).tolist() for x in (self.n_a, self.n_b, np.ones_like(self.n_a), self.n_a * self.n_b)]

    def links(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (A id x ``size`` + B id), how often each is linked and its group, by group. Groups of many tokens go by their distinct ids."""
        times = self.n_b[self.of_a]
        large = self.n_a * self.n_b > 10_000
        times = np.where(large[self.of_a], 0, times)
        first = np.repeat(np.cumsum(times) - times, times)
        at = np.arange(len(first)) - first + np.repeat(self.first_b[self.of_a], times)
        keys, of = np.repeat(self.a, times) * size + self.b[at], np.repeat(self.of_a, times)
        n = np.ones(len(keys), dtype=np.int64)
        for g in np.flatnonzero(large):
            (x, nx), (y, ny) = (np.unique(t[o == g], return_counts=True) for t, o in ((self.a, self.of_a), (self.b, self.of_b)))
            at = int(np.searchsorted(of, g))
            keys, n, of = (np.insert(old, at, new) for old, new in (
                (keys, (x[:, None] * size + y).ravel()), (n, (nx[:, None] * ny).ravel()), (of, np.full(len(x) * len(y), g))))
        return keys, n, of

    def written(self, words: list[list[str]]) -> list[str]:
        """Each part's groups; ``words`` are the ids with a comma, a bar and a semicolon behind them."""
        total = len(self.a) + len(self.b)
        ids, sep = np.empty(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
        ends = np.cumsum(self.n_a)
        at_a, at_b = np.arange(len(self.a)) + self.first_b[self.of_a], np.arange(len(self.b)) + ends[self.of_b]
        ids[at_a], ids[at_b] = self.a, self.b
        sep[ends + self.first_b - 1] = 1
        sep[ends + self.first_b + self.n_b - 1] = 2
        said = [words[k][i] for i, k in zip(ids.tolist(), sep.tolist(), strict=True)]
        stops = (ends + self.first_b + self.n_b)[self.last].tolist()
        return ["".join(said[x:y])[:-1] for x, y in zip([0, *stops[:-1]], stops, strict=True)]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's own: it outlives a task."""
    return Aligner(path_a, path_b)


# first pass: documents of each pair
def _pairs_of_task(path_a: str, path_b: str):
    def put_out(part: int, keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        seg = (mixed(keys, LEVEL_OF_SEGMENTS) >> np.uint64(56)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        keys, counts, seg = keys[order], counts[order], seg[order]
        cuts = np.flatnonzero(np.diff(seg)) + 1
        k, c = np.split(keys, cuts), np.split(counts, cuts)
        return pd.DataFrame({"seg": [int(s[0]) for s in np.split(seg, cuts)], "part": part,
                             "keys": [x.astype("<u8").tobytes() for x in k], "counts": [x.astype("<i8").tobytes() for x in c]})

    def added(held: list) -> list:
        keys = np.concatenate([k for k, _ in held])
        keys, at = np.unique(keys, return_inverse=True)
        return [(keys, np.bincount(at, weights=np.concatenate([c for _, c in held]), minlength=len(keys)).astype(np.int64))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, one = TaskContext.get().partitionId(), aligner(path_a, path_b)
        memory = _memory(("pairs", path_a, path_b), one, _pairs_of(one), bytes.__add__, PAIRS_REMEMBERED)
        held, loose, distinct = [], 0, 0
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in slices(texts, AT_ONCE):
                parts, of, offsets = one.parts(texts[a:b])
                pairs = _made(memory, parts)
                without = _has(pairs, of, offsets)
                pairs = joined(pa.array([x or b"" for x in pairs], pa.large_binary()), of, offsets).to_pylist()
                of_docs = [np.unique(np.frombuffer(x, dtype=one.kind)) for x, no in zip(pairs, without, strict=True) if x and not no]
                if of_docs:
                    held.append(np.unique(np.concatenate(of_docs), return_counts=True))
                    loose += len(held[-1][0])
                if loose > distinct + 1_000_000:
                    held = added(held)
                    loose = distinct = len(held[0][0])
                    if distinct > HELD_PAIRS:
                        yield pa.RecordBatch.from_pandas(put_out(part, *held[0]), preserve_index=False)
                        held, loose, distinct = [], 0, 0
        if held:
            yield pa.RecordBatch.from_pandas(put_out(part, *added(held)[0]), preserve_index=False)
    return work


def _made(memory: Memory, parts: list[str]) -> list:
    """What the memory has of each part; None of an empty one."""
    found = memory.learn({p for p in parts if p})
    out = [found[p] if p else None for p in parts]
    memory.forget()
    return out


def _has(made: list, of: np.ndarray, offsets: np.ndarray) -> list[bool]:
    """Whether each text has a part of which there is nothing."""
    none = np.array([x is None for x in made], dtype=np.int64)
    return (_sums(none, of, offsets) > 0).tolist()


def _sums(of_parts: np.ndarray, of: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text the sum of its parts' values."""
    return np.diff(np.concatenate([[0], np.cumsum(of_parts[of])])[offsets])


#: Seed of the hash that deals pairs to segments (others than the levels of the perfect hashes).
LEVEL_OF_SEGMENTS = 1 << 20
_MEMORIES: dict = {}


def _memory(key: tuple, one: Aligner, make, add, remembered: int) -> Memory:
    """The worker's memory of a kind; only the newest kind stays. ``make`` turns alignments into results,
    ``add`` puts the results of a word and of the mark behind it together."""
    if key not in _MEMORIES:
        _MEMORIES.clear()

        def each(parts):
            return one.each(parts, make)
        marks = {m: one.mark(m, make) for m in one.marks}
        memory = Memory(None, remembered)
        memory.make = lambda parts: memory.by_words(parts, each, marks, lambda x, y: None if x is None or y is None else add(x, y))
        _MEMORIES[key] = memory
    return _MEMORIES[key]


def _pairs_of(one: Aligner):
    """Of each part its pairs, as bytes."""
    def make(found: Aligned) -> list[bytes]:
        keys, _, of = found.links(one.n_b)
        data, size = keys.astype(one.kind).tobytes(), np.dtype(one.kind).itemsize
        stops = (np.searchsorted(of, found.last, side="right") * size).tolist()
        return [data[x:y] for x, y in zip([0, *stops[:-1]], stops, strict=True)]
    return make


def _tree(rows: DataFrame, schema: str, merge, last: bool = True) -> DataFrame:
    """Rows (seg, part, ...) merged ``FAN_IN`` parts at a time until each segment is one row."""
    top = rows.agg(F.max("part")).first()[0] or 0
    while top or last:
        last = False
        rows = stage(rows.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("seg", "part").applyInPandas(merge, schema), "align-tree")
        top //= FAN_IN
    return rows


def _distinct(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = np.unique(np.concatenate([np.frombuffer(k, dtype="<u8") for k in pdf["keys"]]))
    return pd.DataFrame({"seg": [pdf["seg"].iloc[0]], "part": [pdf["part"].iloc[0]], "keys": [keys.tobytes()]})


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each segment: the perfect hash, and its pairs at their places."""
    for pdf in batches:
        hashes, places = [], []
        for data in pdf["keys"]:
            keys = np.frombuffer(data, dtype="<u8")
            h = PerfectHash.build(keys)
            at = np.empty(len(keys), dtype="<u8")
            at[h.number(keys)] = keys
            hashes.append(h.to_bytes())
            places.append(at.tobytes())
        yield pd.DataFrame({"seg": pdf["seg"], "hash": hashes, "pairs": places})


def _dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's numbers of a segment as a dense vector, its pairs' hashes being the places."""
    for pdf in batches:
        out = []
        for data, keys, counts in zip(pdf["hash"], pdf["keys"], pdf["counts"], strict=True):
            h = PerfectHash.from_bytes(data)
            vector = np.zeros(h.n, dtype="<i8")
            vector[h.number(np.frombuffer(keys, dtype="<u8"))] = np.frombuffer(counts, dtype="<i8")
            out.append(vector.tobytes())
        yield pd.DataFrame({"seg": pdf["seg"], "part": pdf["part"], "counts": out})


def _sum(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(pdf["counts"].iloc[0], dtype="<i8").copy()
    for data in pdf["counts"].iloc[1:]:
        total += np.frombuffer(data, dtype="<i8")
    return pd.DataFrame({"seg": [pdf["seg"].iloc[0]], "part": [pdf["part"].iloc[0]], "counts": [total.tobytes()]})


def pair_table(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """seg, hash (perfect hash of the segment's pairs), pairs (at their places), counts (documents that hold each).

    Staged in the shared folder; a row is a segment. No links in the corpus: no rows.
    """
    python_batches(docs.sparkSession)
    found = docs.select(F.col(text).alias("text")).mapInArrow(
        _pairs_of_task(path_a, path_b), "seg long, part long, keys binary, counts binary")
    found = stage(found, "align-pairs")
    union = _tree(found.select("seg", "part", "keys"), "seg long, part long, keys binary", _distinct)
    hashes = stage(union.select("seg", "keys").mapInPandas(_hashed, "seg long, hash binary, pairs binary"), "align-hash")
    vectors = found.join(hashes.select("seg", "hash"), "seg").select("seg", "part", "hash", "keys", "counts")
    sums = _tree(vectors.mapInPandas(_dense, "seg long, part long, counts binary"),
                 "seg long, part long, counts binary", _sum)
    return stage(hashes.join(sums.select("seg", "counts"), "seg"), "align-table")


def pair_rows(table: DataFrame, n_b: int) -> DataFrame:
    """``pair_table`` as rows: pair (A id x ``n_b`` + B id), id_a, id_b, n_docs."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for pairs, counts in zip(pdf["pairs"], pdf["counts"], strict=True):
                keys = np.frombuffer(pairs, dtype="<u8").astype(np.int64)
                yield pd.DataFrame({"pair": keys, "id_a": keys // n_b, "id_b": keys % n_b,
                                    "n_docs": np.frombuffer(counts, dtype="<i8")})
    return table.select("pairs", "counts").mapInPandas(rows, "pair long, id_a long, id_b long, n_docs long")


# second pass: counts of each document's links
class PairCounts:
    """The corpus' counts of pairs, looked up through the segments' perfect hashes."""

    def __init__(self, segments: dict[int, tuple], n_b: int):
        self.segments, self.n_b = segments, n_b      # hash as bytes, pairs, counts
        top = max((int(p.max()) for _, p, _ in segments.values() if len(p)), default=0) // n_b + 1
        self.most = np.zeros(top, dtype=np.int64)
        for _, pairs, counts in segments.values():
            np.maximum.at(self.most, (pairs // n_b).astype(np.int64), counts)
        self._hashes: dict[int, PerfectHash] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_hashes": {}}

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of each pair (0 of one that no document holds), and whether no pair of its A id has more."""
        out = np.zeros(len(keys), dtype=np.int64)
        seg = (mixed(keys, LEVEL_OF_SEGMENTS) >> np.uint64(56)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(seg[order])) + 1):
            if not len(at):
                continue
            s = int(seg[at[0]])
            if s not in self.segments:
                continue
            data, pairs, counts = self.segments[s]
            if s not in self._hashes:
                self._hashes[s] = PerfectHash.from_bytes(data)
            place = self._hashes[s].number(keys[at])
            same = (place >= 0) & (pairs[place] == keys[at])
            out[at[same]] = counts[place[same]]
        id_a = (keys // np.uint64(self.n_b)).astype(np.int64)
        return out, out == self.most[np.minimum(id_a, len(self.most) - 1)]


def _scored(one: Aligner, counts: PairCounts):
    """Of each part: groups, n_a, n_b, n_groups, n_links, n_best, count_sum, and whether all its pairs were
    counted (not so of parts that only stand in texts without tokens)."""
    def make(found: Aligned) -> list[tuple]:
        keys, times, of = found.links(one.n_b)
        n, best = counts.of(keys.astype(np.uint64))
        groups = len(found.n_a)
        sums = [found.per_part(np.bincount(of, weights=w, minlength=groups).astype(np.int64)).tolist() for w in (times * best, times * n, n == 0)]
        known = [x == 0 for x in sums[2]]
        return list(zip(found.written(one.words), *found.counts(), *sums[:2], known, strict=True))
    return make


def _linked(one: Aligner):
    """Of each part the same without sums, and its pairs and how often each is linked, for the join."""
    def make(found: Aligned) -> list[tuple]:
        keys, times, of = found.links(one.n_b)
        stops = np.searchsorted(of, found.last, side="right").tolist()
        cuts = list(zip([0, *stops[:-1]], stops, strict=True))
        pairs, times = ([x[i:j].astype("<i8").tobytes() for i, j in cuts] for x in (keys, times))
        none = [0] * len(cuts)
        return list(zip(found.written(one.words), *found.counts(), none, none, [True] * len(cuts), pairs, times, strict=True))
    return make


def _together(x: tuple, y: tuple) -> tuple:
    """Results of two parts that follow each other without a blank."""
    return (f"{x[0]};{y[0]}", *[i + j for i, j in zip(x[1:7], y[1:7], strict=True)], x[7] and y[7], *[i + j for i, j in zip(x[8:], y[8:], strict=True)])


_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align_tokens(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
                 with_groups: bool = True, table: DataFrame | None = None,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Of every document: key, n_a, n_b (tokens), n_groups, n_links, n_best (links that no pair of their A id exceeds
    in documents), count_sum (documents of its links' pairs, added up), groups_sha256 and, if asked for, groups
    (``a1,a2|b1;a3|b2,b3``).

    A encodes a blank and the text, B the text (in front of which it sets a blank); strings of special tokens
    are plain text. Texts that are null, empty or do not come back byte for byte from both have no
    tokens: zeros, and '' for groups and digest. Every row is a document, rows of equal key or text too;
    other columns are not looked at. ``table``: counts of another corpus' ``pair_table``; by default those
    of ``docs`` itself (it must hold every pair of ``docs``). Pairs and counts of up to
    ``broadcast_bytes`` go to the tasks, more are joined by pair.
    """
    spark = docs.sparkSession
    python_batches(spark)
    table = pair_table(docs, path_a, path_b, text) if table is None else table
    size = table.agg(F.sum(F.length("hash") + F.length("pairs") + F.length("counts"))).first()[0] or 0
    small = size <= broadcast_bytes
    n_b = aligner(path_a, path_b).n_b
    shared, run = None, uuid.uuid4().hex
    if small:
        segments = {r["seg"]: (bytes(r["hash"]), np.frombuffer(r["pairs"], dtype="<u8"), np.frombuffer(r["counts"], dtype="<i8"))
                    for r in table.collect()}      # at most broadcast_bytes
        shared = spark.sparkContext.broadcast(PairCounts(segments, n_b))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = rows.select("key").schema
    for c in _COLUMNS:
        schema = schema.add(c, "long")
    schema = schema.add("groups_sha256", "string")
    if with_groups:
        schema = schema.add("groups", "string")
    if not small:
        schema = schema.add("row", "long").add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.LongType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        one = aligner(path_a, path_b)
        memory = _memory((run, path_a, path_b), one, _scored(one, shared.value) if small else _linked(one), _together, REMEMBERED)
        row = TaskContext.get().partitionId() << 33
        nothing = ("", 0, 0, 0, 0, 0, 0, True, b"", b"")
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts, AT_ONCE):
                parts, of, offsets = one.parts(texts[a:b])
                made = _made(memory, parts)
                without = np.array(_has(made, of, offsets)) | (offsets[1:] == offsets[:-1])
                made = [x or nothing for x in made]
                if small and (~without & (_sums(np.array([not x[7] for x in made], dtype=np.int64), of, offsets) > 0)).any():
                    raise RuntimeError("the table of pairs does not hold a pair of these documents")
                out = {}
                for k, c in enumerate(_COLUMNS, 1):
                    out[c] = np.where(without, 0, _sums(np.array([x[k] for x in made], dtype=np.int64), of, offsets))
                said = joined(pa.array([x[0] for x in made], pa.large_string()), of, offsets, ";").to_pylist()
                said = ["" if no else x for x, no in zip(said, without.tolist(), strict=True)]
                out["groups_sha256"] = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in said]
                if with_groups:
                    out["groups"] = said
                if not small:
                    out["row"] = row + np.arange(len(said))
                    row += len(said)
                    out["pairs"], out["times"] = [], []
                    of_docs = [joined(pa.array([x[k] for x in made], pa.large_binary()), of, offsets).to_pylist() for k in (8, 9)]
                    for pairs, times, no in zip(*of_docs, without.tolist(), strict=True):
                        pairs, times = (np.frombuffer(b"" if no else x, dtype="<i8") for x in (pairs, times))
                        keys, at = np.unique(pairs, return_inverse=True)
                        out["pairs"].append(keys.astype(np.int64))
                        out["times"].append(np.bincount(at, weights=times, minlength=len(keys)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a)] + [pa.array(out[f.name], _ARROW[f.dataType.simpleString()]) for f in schema.fields[1:]],
                    [f.name for f in schema.fields])
    done = rows.mapInArrow(work, schema)
    if not small:
        done = _joined_counts(stage(done, "align-links"), pair_rows(table, n_b))
    names = ["groups"] if with_groups else []
    return done.select(F.col("key").alias(key), *_COLUMNS, "groups_sha256", *names)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}


def _joined_counts(done: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by a join of the documents' pairs with the counts."""
    counts = stage(counts, "align-counts")
    most = counts.groupBy("id_a").agg(F.max("n_docs").alias("most"))
    counts = counts.join(most, "id_a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).cast("long").alias("best"))
    links = done.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    sums = links.join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("b"),
                                                         F.sum(F.col("times") * F.col("n_docs")).alias("s"))
    done = done.drop("n_best", "count_sum", "pairs", "times").join(sums, "row", "left")
    return done.withColumns({"n_best": F.coalesce("b", F.lit(0)), "count_sum": F.coalesce("s", F.lit(0))})
