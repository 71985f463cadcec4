"""Near duplicates among embeddings by a subspace pigeonhole join (operator 6).

Unit vectors are rotated at random and cut into blocks of few dimensions. Two
vectors at squared distance D are, in at least one block, within D times the
block's share of the dimensions; so each block is range-joined under that
budget on a grid over its first coordinates (the more, the more vectors a label
has), and every pair found is verified exactly. A vector goes to its own cell and
to those after it that it reaches, so that a pair meets in one cell of a block.
A pair belongs to the first block that finds it. Links are counted and
reduced to components inside a task, never written out as pairs. Large tables go
block by block and by parts of the cells, so that few copies are on disk at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import each_group, python_batches, stage
from tidemark.llm.components import connected_components
from tidemark.llm.shingles import mix

#: Rows that a cell of the grid should have; cells of over WIDE times as many go as pairs of blocks of that size.
BLOCK, WIDE = 1500, 4
#: Distinct vectors that are dealt to cells in one round, and the rounds that a block of dimensions is gone through in at most.
ROUND_ROWS, PARTS = 50_000, 4
#: Labels or large cells up to which their list is broadcast.
BROADCAST_ROWS = 500_000


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dim, min(blocks, dim) + 1).round().astype(int)


def _links(x: np.ndarray, y: np.ndarray, block: int, edges: np.ndarray, limit: float, least: float):
    """Index pairs (i of x, j of y) that are linked and that no block before ``block`` finds."""
    dim = x.shape[1]
    for k in range(0, len(x), 256):
        i, j = np.nonzero(x[k:k + 256] @ y.T >= least - 1e-9)
        i = i + k
        for c in range(0, len(i), 4096):       # exact, and the blocks' distances, pair by pair
            a, b = i[c:c + 4096], j[c:c + 4096]
            p, q = x[a], y[b]
            ok = np.einsum("ij,ij->i", p, q) >= least
            d = np.add.reduceat((p - q) ** 2, edges[:-1], axis=1)
            near = d <= limit * np.diff(edges) / dim
            ok &= near[:, block] & ~near[:, :block].any(axis=1)
            yield a[ok], b[ok]


def _components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _unit(v: np.ndarray) -> np.ndarray:
    x = v.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(g: np.ndarray, cell: float, reach: float, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``g``, each with the key of its own cell and of those after it (in the order of their coordinates) that it
    is within ``reach`` of; and which are its own."""
    row, gap2, ahead = np.arange(len(g)), np.zeros(len(g)), np.zeros(len(g), dtype=bool)
    key = np.full(len(g), block + 1, dtype=np.uint64)
    span = int(np.ceil(reach / cell))
    for d in range(g.shape[1]):
        x, parts = g[row, d], []
        home = np.floor(x / cell)
        for step in range(-span, span + 1):
            at = home + step
            # distance from the point to the cell in this coordinate
            far = gap2 + np.maximum(np.maximum(at * cell - x, x - (at + 1) * cell), 0) ** 2
            take = np.flatnonzero((far <= reach ** 2) & (ahead | (step >= 0)))
            parts.append((row[take], mix(key[take] * np.uint64(0x9E3779B97F4A7C15) + at[take].astype(np.int64).astype(np.uint64)),
                          far[take], ahead[take] | (step > 0)))
        row, key, gap2, ahead = (np.concatenate(p) for p in zip(*parts))
    return row, key, ~ahead


def link_vectors(vectors: DataFrame, least: float = 0.98, blocks: int = 8, grid_dims: int = 2,
                 cell: float = 0.25, block_rows: int = BLOCK, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label", round_rows: int = ROUND_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors of equal, non-null label (and dimension) are linked if their cosine
    in double precision is ``least`` or more. Vectors that are null, empty,
    zero or hold a null or non-finite number link with nothing, as do rows of
    null label or null id (their component is their id, kept true). Equal
    vectors are compared as one and counted each; a repeated id counts as a
    link of its own row. Other columns are not read; an empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    python_batches(spark, 2000)
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
           & finite & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    same = (rows.where("fit").groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    same = stage(same.withColumn("dim", F.size("v")), "vec-same")
    limit = 2.0 * (1.0 - least) + 1e-9

    label_type = same.schema["label"].dataType.simpleString()
    # a label of many vectors has a grid of more coordinates: one cuts a cell to about a half
    labels = same.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
    labels = stage(labels, "vec-labels")
    wide = F.greatest(F.lit(grid_dims), F.ceil(F.log2(F.col("_n") / F.lit(block_rows))).cast("int"))
    gridded = same.join(F.broadcast(labels) if labels.count() <= BROADCAST_ROWS else labels, ["label", "dim"], "left").select(
        "id", "label", "copies", "dim", "v", F.when(F.col("_n").isNull(), grid_dims).otherwise(wide).alias("grid"))

    def deal(now: range, part: int, parts: int, whole: bool) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            turned = {}
            for batch in batches:
                for (dim, grid), rows in batch.groupby(["dim", "grid"]):
                    dim, grid = int(dim), int(grid)
                    if dim not in turned:
                        turned[dim] = rotation(dim), block_edges(dim, blocks)
                    turn, edges = turned[dim]
                    v = np.array(rows["v"].tolist(), dtype=kind)
                    x, raw = _unit(v), np.array([r.tobytes() for r in v] if whole else [], dtype=object)
                    ids, labels, copies = (rows[c].to_numpy() for c in ("id", "label", "copies"))
                    for b in now:
                        if b + 1 >= len(edges):
                            break
                        lo, hi = edges[b], edges[b + 1]
                        reach = np.sqrt(limit * (hi - lo) / dim) * (1 + 1e-9)
                        row, key, home = _cells(x @ turn[:, lo:min(hi, lo + grid)], cell, reach, b)
                        if parts > 1:
                            take = np.flatnonzero(key % np.uint64(parts) == part)
                            row, key, home = row[take], key[take], home[take]
                        out = {"label": labels[row], "dim": dim, "block": b, "cell": key.astype(np.int64)}
                        if whole:
                            out |= {"id": ids[row], "copies": copies[row], "home": home, "x": raw[row]}
                        yield pd.DataFrame(out)
        return run

    keys = ["label", "dim", "block", "cell"]
    cell_type = f"label {label_type}, dim int, block int, cell long"
    groups = [*keys, "_bi", "_bj"]
    # the cells of more rows than a pair should have; they are few
    large = gridded.join(labels.select("label", "dim"), ["label", "dim"], "left_semi") if labels.limit(1).count() else gridded.limit(0)
    large = large.mapInPandas(deal(range(blocks), 0, 1, False), cell_type).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = stage(large.where(F.col("_n") > WIDE * block_rows), "vec-large")
    few = large.count() <= BROADCAST_ROWS

    def in_pairs(dealt: DataFrame) -> DataFrame:
        """Rows of large cells dealt to pairs of blocks (as ``in_blocks`` does); the others are one block."""
        out = dealt.join(F.broadcast(large) if few else large, keys, "left")
        out = out.withColumn("_s", F.coalesce(F.ceil(F.col("_n") / F.lit(WIDE * block_rows)).cast("int"), F.lit(1)))
        out = out.withColumn("_b", F.pmod(F.xxhash64("id", F.lit(17)), F.col("_s")).cast("int"))
        out = out.withColumn("_x", F.explode(F.expr("sequence(0, _s - 1)")))
        return out.withColumn("_bi", F.least("_b", "_x")).withColumn("_bj", F.greatest("_b", "_x")).drop("_x", "_n", "_s")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size, turned = [], 0, {}
        for g in each_group(batches, groups):
            if len(g["id"]) < 2:
                continue
            dim, block = int(g["dim"][0]), int(g["block"][0])
            if dim not in turned:
                turned[dim] = rotation(dim), block_edges(dim, blocks)
            turn, edges = turned[dim]
            x = _unit(np.frombuffer(b"".join(g["x"]), dtype=kind).reshape(-1, dim)) @ turn
            home, side, bi, bj = g["home"].astype(bool), g["_b"], g["_bi"][0], g["_bj"][0]
            n = np.zeros(len(x), dtype=np.int64)
            ends_i, ends_j = [], []
            # the cell's own rows against all, once each pair
            own, reaching = [np.flatnonzero(home & (side == b)) for b in (bi, bj)], [np.flatnonzero(~home & (side == b)) for b in (bi, bj)]
            sides = [(own[0], own[0]), (own[0], reaching[0])] if bi == bj else [(own[0], own[1]), (own[0], reaching[1]), (own[1], reaching[0])]
            for left, right in sides:
                if not len(left) or not len(right):
                    continue
                for i, j in _links(x[left], x[right], block, edges, limit, least):
                    if left is right:
                        once = i < j
                        i, j = i[once], j[once]
                    i, j = left[i], right[j]
                    np.add.at(n, i, g["copies"][j])
                    np.add.at(n, j, g["copies"][i])
                    ends_i.append(i)
                    ends_j.append(j)
            if ends_i and sum(map(len, ends_i)):
                i, j = np.concatenate(ends_i), np.concatenate(ends_j)
                low = _components(len(x), i, j)
                hit = np.flatnonzero((n > 0) | (low != np.arange(len(x))))
                out.append(pd.DataFrame({"id": g["id"][hit], "n": n[hit], "low": g["id"][low[hit]]}))
                size += len(hit)
                if size > 50_000:
                    yield pd.concat(out)
                    out, size = [], 0
        if out:
            yield pd.concat(out)

    total = -(-same.count() // round_rows)
    at_once, parts = max(1, blocks // max(1, total)), max(1, min(PARTS, -(-total // blocks)))
    found = []
    for b in range(0, blocks, at_once):
        for part in range(parts):
            dealt = gridded.mapInPandas(deal(range(b, min(blocks, b + at_once)), part, parts, True),
                                        f"{cell_type}, id long, copies long, home boolean, x binary")
            dealt = in_pairs(dealt).repartition(*groups).sortWithinPartitions(*groups, "id")
            found.append(stage(dealt.mapInPandas(linked, "id long, n long, low long"), "vec-links"))
    found = reduce(DataFrame.unionByName, found)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    parts = connected_components(found.where("id <> low").select("id", "low").distinct())
    node = (same.select("label", "v", "id", "copies").join(counts, "id", "left")
            .join(parts.withColumnRenamed("node", "id"), "id", "left")
            .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                    F.coalesce("component", "id").alias("c")))
    fitting = rows.where("fit").join(node, ["label", "v"]).select("vec_id", F.col("n").alias("n_links"),
                                                                  F.col("c").alias("component_id"))
    rest = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return fitting.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
