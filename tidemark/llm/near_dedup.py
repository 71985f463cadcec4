"""Near duplicates by MinHash (operator 7).

A shingle set is one node, whatever documents have it. Signatures of many universal
hash minima are cut into bands; nodes that share a band may be linked. First
every node is held against the smallest node of each of its bands: candidates
pass the signatures, then the full shingle sets. Links found so far give
components (large-star, small-star). Then, within a band, nodes of different
components are held against each other in blocks inside a task, by signature and
by full set, and only links that join two components are written: a large group
of copies makes a star and not all its pairs, and no link between components is
lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.common import each_group, in_blocks, python_batches, stage
from tidemark.llm.components import connected_components
from tidemark.llm.shingles import mix, shingle_sets

#: Bands and minima in a band: a pair at similarity 0.75 shares no band once in four million.
BANDS, ROWS = 40, 4
#: Signatures that agree in a smaller share are no candidates: over four standard errors below 0.75.
SIGNATURE_LEAST = 0.6
#: Ids of candidates up to which they are broadcast (8 MB); beyond, their texts are found by a shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of a block within a band, and shingles that they have together.
BLOCK, BLOCK_SHINGLES = 1000, 2_000_000


def minhash(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of the functions a*x + b modulo 2**32 over the set ``s``."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(out, (x[k:k + 1024, None] * a[None, :] + b[None, :]).min(axis=0), out=out)
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """Two numbers that tell sets apart."""
    if not len(s):
        return 0, 0
    return int(s.sum().astype(np.int64)), int(np.bitwise_xor.reduce(mix(s + np.uint64(77))).astype(np.int64))


def signatures(docs: DataFrame, size: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set digest (d1, d2), a byte of each minimum, and the band keys."""
    python_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(20240229)
        a = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
        weights = mix(np.arange(101, 101 + rows, dtype=np.uint64)) | np.uint64(1)
        salts = mix(np.arange(1001, 1001 + bands, dtype=np.uint64))
        for batch in batches:
            n, d1, d2, sig, keys = [], [], [], [], []
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for s in shingle_sets(texts, size):
                n.append(len(s))
                for d, x in zip((d1, d2), digest(s), strict=True):
                    d.append(x)
                m = minhash(s, a, b)
                sig.append((m >> np.uint32(24)).astype(np.uint8).tobytes())
                keys.append(mix((m.reshape(bands, rows).astype(np.uint64) * weights).sum(axis=1) ^ salts))
            flat = np.concatenate(keys).astype(np.int64) if keys else np.zeros(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(sig, pa.binary()), lists],
                ["doc_id", "n_shingles", "d1", "d2", "sig", "bands"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, d1 long, d2 long, sig binary, bands array<long>")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """The set of every text, with its digest."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets([(t or "").encode("utf-8", "surrogatepass")
                                       for t in batch.column(0).to_pylist()], size))
            offsets = np.cumsum([0] + [len(s) for s in found]).astype(np.int32)
            values = np.concatenate(found).astype(np.int64) if found else np.zeros(0, dtype=np.int64)
            digests = [digest(s) for s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in digests], pa.int64()), pa.array([d for _, d in digests], pa.int64()),
                 pa.array(np.diff(offsets), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], [*_SET, "s"])

    return texts.select("text").mapInArrow(sets, "d1 long, d2 long, n_shingles long, s array<long>")


#: What tells sets apart.
_SET = ["d1", "d2", "n_shingles"]


@F.pandas_udf(DoubleType())
def _agreement(x: pd.Series, y: pd.Series) -> pd.Series:
    if not len(x):
        return pd.Series([], dtype="float64")
    a = np.frombuffer(b"".join(x), dtype=np.uint8).reshape(len(x), -1)
    b = np.frombuffer(b"".join(y), dtype=np.uint8).reshape(len(y), -1)
    return pd.Series((a == b).mean(axis=1))


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets have den * intersection >= num * union."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("i")
    return both.withColumn("i", common).where(den * F.col("i") >= num * union).select("a", "b")


_GROUP = ["key", "_bi", "_bj"]


def _sides(g: dict) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of a pair of blocks that are held against each other, and whether they are one block."""
    return (np.flatnonzero(g["_b"] == g["_bi"][0]), np.flatnonzero(g["_b"] == g["_bj"][0]),
            g["_bi"][0] == g["_bj"][0])


def _across(member: DataFrame, found: DataFrame, byte: DataFrame, sets: DataFrame, num: int, den: int,
            block: int) -> DataFrame:
    """Links (a, b) that join different components: pairs of nodes that share a band.

    Two passes over each pair of blocks of a band. The first holds signatures
    against each other and passes on the nodes (not the pairs) that have a
    candidate of another component; the second gets their full sets, tests
    every pair of different components and gives one link for each two that it
    joins.
    """
    now = member.select("key", "k", F.col("b").alias("id")).join(
        found.select(F.col("node").alias("id"), "component"), "id", "left"
    ).select("key", "k", "id", F.coalesce("component", "id").alias("c"))
    open_ = now.groupBy("key").agg(F.min("c").alias("_l"), F.max("c").alias("_h")).where("_l <> _h").select("key")
    open_ = stage(now.join(open_, "key").join(byte, "id"), "near-open")
    dealt = in_blocks(open_, ["key"], block, "id", "n", BLOCK_SHINGLES).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id")

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for g in each_group(batches, _GROUP):
            left, right, one = _sides(g)
            sig = np.frombuffer(b"".join(g["sig"]), dtype=np.uint8).reshape(len(g["id"]), -1)
            bands = np.stack(g["bands"])
            c, n, band = g["c"], g["n"], g["k"][0]
            hit = np.zeros(len(c), dtype=bool)
            for i in left:
                r = right[right > i] if one else right
                r = r[(c[r] != c[i]) & (den * np.minimum(n[r], n[i]) >= num * np.maximum(n[r], n[i]))]
                r = r[(sig[r] == sig[i]).mean(axis=1) >= SIGNATURE_LEAST] if len(r) else r
                if len(r):      # a pair is tested in the first band that it shares
                    r = r[(bands[r] == bands[i]).argmax(axis=1) == band]
                if len(r):
                    hit[i] = True
                    hit[r] = True
            at = np.flatnonzero(hit)
            if len(at):
                out.append(pd.DataFrame({k: g[k][at] for k in (*_GROUP, "_b", "id", "c", "n")}))
                size += len(at)
            if size > 50_000:
                yield pd.concat(out)
                out, size = [], 0
        if out:
            yield pd.concat(out)

    rows = stage(dealt.mapInPandas(candidates, "key long, _bi int, _bj int, _b int, id long, c long, n long"), "near-rows")
    full = (rows.join(sets.select("id", "s"), "id").repartition(*_GROUP)
            .sortWithinPartitions(*_GROUP, "id"))

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for g in each_group(batches, _GROUP):
            left, right, one = _sides(g)
            ids, n = g["id"], g["n"]
            label = np.unique(g["c"], return_inverse=True)[1]
            flat = np.unique(np.concatenate(g["s"]), return_inverse=True)[1]
            begins = np.cumsum(np.concatenate([[0], n[:-1]]))
            mark = np.zeros(flat.max() + 1, dtype=np.int32)
            for i in left:
                if (label[right] == label[i]).all():
                    continue
                own = flat[begins[i]:begins[i] + n[i]]
                mark[own] = 1
                common = np.add.reduceat(mark[flat], begins)
                mark[own] = 0
                r = right[(den * common[right] >= num * (n[right] + n[i] - common[right])) & (label[right] != label[i])]
                for x in r:
                    if label[x] != label[i]:
                        a.append(min(ids[x], ids[i]))
                        b.append(max(ids[x], ids[i]))
                        label[label == label[x]] = label[i]
        yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return full.mapInPandas(test, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 75, den: int = 100, bands: int = BANDS,
                    rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Words are runs of bytes other than blank and \\x09-\\x0D, A-Z lower-cased;
    documents are linked if den * intersection >= num * union of their sets of
    ``size``-word shingles (fewer words: the whole sequence is one shingle).
    Null and empty texts have an empty set and link with nothing, as do rows
    without an id (their component is null, kept true). Rows of one doc_id are one
    document: it links with what any of its texts links with. Other columns are not
    read; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stage(signatures(docs, size, bands, rows), "near-sig")
    same = (sig.where("n_shingles > 0 and doc_id is not null").groupBy(*_SET)
            .agg(F.min_by(F.struct("doc_id", "sig", "bands"), "doc_id").alias("x")))
    # a set's number; it holds as the table is written
    nodes = stage(same.select(*_SET, "x.*", F.monotonically_increasing_id().alias("id")), "near-nodes")
    keyed = nodes.select(F.posexplode("bands").alias("k", "key"), F.col("id").alias("b"))
    shared = keyed.groupBy("key").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    member = stage(keyed.join(shared, "key"), "near-bands")
    star = member.where("a <> b").select("a", "b").distinct()
    byte = nodes.select("id", "sig", F.col("n_shingles").alias("n"), "bands")
    star = (star.join(byte.select(F.col("id").alias("a"), F.col("sig").alias("x"), F.col("n").alias("m")), "a")
            .join(byte.select(F.col("id").alias("b"), F.col("sig").alias("y"), "n"), "b")
            .where(den * F.least("m", "n") >= num * F.greatest("m", "n"))
            .where(_agreement("x", "y") >= SIGNATURE_LEAST).select("a", "b"))
    star = stage(star, "near-star")
    # the texts that stand for the nodes in question; their sets find the nodes by digest
    wanted = stage(nodes.join(member.select(F.col("b").alias("id")).distinct(), "id").select("id", "doc_id", *_SET), "near-ids")
    few = wanted.count() <= BROADCAST_IDS
    ids, wanted = wanted.select("doc_id").distinct(), wanted.drop("doc_id")
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    sets = _sets(texts, size).join(F.broadcast(wanted) if few else wanted, _SET)
    sets = stage(sets.dropDuplicates(["id"] if few else _SET).select("id", "s"), "near-sets")
    found = connected_components(stage(_confirm(star, sets, num, den), "near-links"))

    # what the stars have left apart
    more = stage(_across(member, found, byte, sets, num, den, block), "near-more")
    if more.limit(1).count():
        found = connected_components(found.where("node <> component").select("node", "component").union(more))

    # a document of several sets is one
    of = stage(sig.select("doc_id", *_SET).join(nodes.select(*_SET, "id"), _SET, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("id")), "near-of")
    several = of.where("id is not null").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z")
    tied = stage(of.join(several.select("doc_id", "a"), "doc_id").where("id <> a").select("a", "id").distinct(), "near-tied")
    if tied.limit(1).count():
        found = connected_components(found.where("node <> component").select("node", "component").union(tied))

    of = of.join(found.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "id").alias("_c"))
    least = of.where("_c is not null").groupBy("_c").agg(F.min("doc_id").alias("_least"))
    # all rows of a document, those of an empty set too, have what its sets have
    of_doc = of.join(least, "_c").groupBy("doc_id").agg(F.min("_least").alias("_least"))
    out = of.join(of_doc, "doc_id", "left")
    component = F.coalesce("_least", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
