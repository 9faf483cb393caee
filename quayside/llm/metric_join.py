"""Exact metric range join on embeddings, by angle.

Pivots cut the vectors into cells: a vector is at home with its nearest pivot.
By the triangle inequality a vector can only have neighbours in a cell whose
pivot lies within the cell's radius plus the range: it is a guest there.  Cells
are written in blocks of bounded size, a row each, and the product of the blocks
with themselves is read from that one copy: no vector is copied for a task.  Two
blocks meet once, with the guests that each has in the other's cell; a task
reports counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, components, prepare

CELL_VECTORS = 4096   # vectors a pivot stands for
MAX_PIVOTS = 512      # more vectors make larger cells of more blocks, not more pivots
HOME_BLOCK = 4096     # vectors of one block, fewer where they are long
MEMBER_BLOCK = 32768  # vectors of the blocks that one side of a task reads, fewer where they are long
BLOCK_BYTES = 1 << 21  # of the vectors of one block
ARROW_PAIRS = 4       # pairs of blocks in one Arrow batch
STRIP = 512           # home vectors compared at a time


def _matrix(blobs) -> np.ndarray:
    blobs = list(blobs)
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1) if blobs else np.zeros((0, 0))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Label of each of n vertices: the smallest vertex linked with it by pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def join_block(home: np.ndarray, members: np.ndarray, home_id: np.ndarray, member_id: np.ndarray, home_weight: np.ndarray,
               weight: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(weight of the members linked with each home vector, weight of the home
    vectors linked with each member, edge ends a, edge ends b)`` for cosine >=
    threshold; the edges span what is linked.

    A single-precision bound on the leading dimensions plus the length of the
    rest (Cauchy-Schwarz) discards most pairs; what is left is decided by the
    cosine of the given vectors in double precision.
    """
    size_h, size_m = np.linalg.norm(home, axis=1), np.linalg.norm(members, axis=1)
    unit_h, unit_m = home / size_h[:, None], members / size_m[:, None]
    lead = min(home.shape[1], max(16, 3 * home.shape[1] // 8))

    def bounded(x):
        rest = np.sqrt(np.clip((x[:, lead:] ** 2).sum(1), 0, None))
        return np.concatenate([x[:, :lead], rest[:, None]], 1).astype(np.float32)

    bound_h, bound_m = bounded(unit_h), bounded(unit_m)
    linked, met = np.zeros(len(home), np.int64), np.zeros(len(members), np.int64)
    edges = []
    for at in range(0, len(home), STRIP):
        a, b = np.nonzero(bound_h[at:at + STRIP] @ bound_m.T >= threshold - 1e-4)
        a += at
        sure = np.empty(len(a), bool)
        for k in range(0, len(a), 1 << 18):
            i, j = a[k:k + (1 << 18)], b[k:k + (1 << 18)]
            sure[k:k + (1 << 18)] = np.einsum("ij,ij->i", home[i], members[j]) / (size_h[i] * size_m[j]) >= threshold
        sure &= home_id[a] != member_id[b]
        a, b = a[sure], b[sure]
        if len(a):
            linked += np.bincount(a, weight[b], len(home)).astype(np.int64)
            met += np.bincount(b, home_weight[a], len(members)).astype(np.int64)
            label = _forest(a, b + len(home), len(home) + len(members))
            seen = np.flatnonzero(label != np.arange(len(label)))
            edges.append(np.stack([seen, label[seen]], 1))
    if not edges:
        none = np.zeros(0, np.int64)
        return linked, met, none, none
    pairs = np.concatenate(edges)
    label = _forest(pairs[:, 0], pairs[:, 1], len(home) + len(members))
    seen = np.flatnonzero(label != np.arange(len(label)))
    ids = np.concatenate([home_id, member_id])
    return linked, met, ids[seen], ids[label[seen]]


def valid(vector) -> "F.Column":
    """Whether a vector can be compared: not null, no null or non-finite part, not zero."""
    return F.coalesce(
        (F.size(vector) > 0)
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = 0.9, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """Links all pairs of rows with cosine >= ``threshold``: ``id, n_links,
    component_id`` (smallest id reachable), one row per input row.

    Equal vectors are one class and count as linked with each other.  Rows whose
    vector cannot be compared, and vectors of different lengths, are not linked.
    Nulls, repeated rows and an empty table are handled: each row stays.  A
    group of copies is collapsed before the join by a partial aggregate; a group
    of near copies, however large, is cut into blocks.  What is written: one row
    per class, block rows, and at most one edge per vector and block.
    """
    spark = vectors.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "metric")
    rows = vectors.select(F.col(id), F.when(valid(F.col(vector)), F.col(vector).cast("array<double>")).alias("__v"))
    classes = scratch.keep(rows.filter("__v IS NOT NULL").groupBy("__v").agg(F.min(id).alias("least"), F.count("*").alias("copies"))
                           .withColumn("cid", F.monotonically_increasing_id()))
    links, edges = _join_cells(classes, threshold, scratch)
    groups = components(spark, edges, scratch)
    linked = links.groupBy("cid").agg(F.sum("linked").alias("linked"))
    # Numbers only: the vectors are met once, to name the rows.
    named = (classes.select("cid", "least", "copies").join(linked, "cid", "left")
             .join(groups.withColumnRenamed("id", "cid"), "cid", "left").withColumn("group", F.coalesce("component_id", "cid")))
    least = named.groupBy("group").agg(F.min("least").alias("component"))
    told = named.join(least, "group").select("cid", "component", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"))
    known = classes.select("cid", "__v").join(told, "cid").drop("cid")
    return rows.join(known, "__v", "left").select(
        F.col(id), F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", F.col(id)).alias("component_id"))


def _join_cells(classes: DataFrame, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    spark = classes.sparkSession
    reach = math.acos(threshold) + 1e-6
    wanted = min(MAX_PIVOTS, max(1, classes.count() // CELL_VECTORS))
    # At most MAX_PIVOTS vectors, the first by hash.
    picked = [np.array(r[0]) for r in classes.orderBy(F.xxhash64("__v"), "cid").select("__v").limit(wanted).collect()]
    pivots = {d: np.stack([p / np.linalg.norm(p) for p in picked if len(p) == d]) for d in {len(p) for p in picked}}
    number = {d: 1 + sum(len(pivots[e]) for e in pivots if e < d) for d in pivots}  # of the first cell of a dimension

    def angles(group: np.ndarray) -> np.ndarray:
        p = pivots[group.shape[1]]
        return np.arccos(np.clip(group / np.linalg.norm(group, axis=1)[:, None] @ p.T, -1, 1))

    def by_length(batch):
        lengths = batch["__v"].map(len).to_numpy()
        for d in np.unique(lengths):
            part = batch[lengths == d]
            yield int(d), part, np.stack(part["__v"].to_numpy()).astype("<f8")

    def assign(batches):
        for batch in batches:
            for d, part, x in by_length(batch):
                if d in pivots:
                    angle = angles(x)
                    home = angle.argmin(1)
                    far, cell = angle[np.arange(len(x)), home], home + number[d]
                else:
                    far, cell = np.zeros(len(x)), np.full(len(x), -d)
                yield pd.DataFrame({"cid": part["cid"].to_numpy(), "copies": part["copies"].to_numpy(), "cell": cell, "far": far,
                                    "x": [v.tobytes() for v in x]})

    homes = scratch.keep(classes.select("cid", "copies", "__v").mapInPandas(assign, "cid long, copies long, cell long, far double, x binary"))
    # One row per pivot (and per length of vectors without pivots).
    cells = {r["cell"]: (r["far"], r["n"]) for r in homes.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}

    # Of each cell: its first block, its number of blocks, the cells that can have guests in it.
    first, blocks, near, n_blocks = {}, {}, {}, 0
    for cell in sorted(cells):
        d = -cell if cell < 0 else next(e for e in pivots if number[e] <= cell < number[e] + len(pivots[e]))
        first[cell], blocks[cell] = n_blocks, -(-cells[cell][1] // max(1, min(HOME_BLOCK, BLOCK_BYTES // (8 * d))))
        n_blocks += blocks[cell]
        near[cell] = [cell]
    for d, p in pivots.items():
        between, own = angles(p), [c for c in near if number[d] <= c < number[d] + len(p)]
        for c in own:
            near[c] += [e for e in own if e != c and min(between[c - number[d], e - number[d]], between[e - number[d], c - number[d]]) <= cells[c][0] + cells[e][0] + reach]

    def place(batches):
        """Rows with the number of their block."""
        for batch in batches:
            cell, salt = batch["cell"].to_numpy(), batch["cid"].to_numpy() * 2654435761 >> 7
            start, n = (np.array([of[c] for c in cell], np.int64) for of in (first, blocks))
            yield batch.drop(columns="far").assign(block=start + salt % np.maximum(n, 1))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        cell = int(group["cell"].iloc[0])
        return pd.DataFrame({"block": group["block"].iloc[:1], "cell": cell, "near": [near[cell]], "cids": [group["cid"].to_numpy("<i8").tobytes()],
                             "copies": [group["copies"].to_numpy("<i8").tobytes()], "x": [b"".join(group["x"])]})

    def compare(batches):
        """Links of all pairs of blocks of a task: a count and an edge per vector."""
        counts, ends = [], []
        for batch in batches:
            for row in batch.itertuples():
                ids, weights, x = [], [], []
                for side, other in (("", "2"), ("2", "")):
                    cid, copies = (np.frombuffer(getattr(row, c + side), "<i8") for c in ("cids", "copies"))
                    v = np.frombuffer(getattr(row, "x" + side), "<f8").reshape(len(cid), -1)
                    cell, met = getattr(row, "cell" + side), getattr(row, "cell" + other)
                    if cell != met:
                        guest = angles(v)[:, met - number[v.shape[1]]] <= cells[met][0] + reach
                        cid, copies, v = cid[guest], copies[guest], v[guest]
                    ids.append(cid), weights.append(copies), x.append(v)
                if not len(ids[0]) or not len(ids[1]):
                    continue
                linked, met, a, b = join_block(*x, *ids, *weights, threshold)
                found = [(ids[0], linked), (ids[1], met)]
                for cid, n in found[:1] if row.block == row.block2 else found:
                    k = np.flatnonzero(n)
                    counts.append(np.stack([cid[k], n[k]]))
                ends.append(np.stack([a, b]))
        if counts:
            (cid, n), (a, b) = np.concatenate(counts, 1), np.concatenate(ends, 1)
            seen, at = np.unique(cid, return_inverse=True)
            total = np.zeros(len(seen), np.int64)
            np.add.at(total, at, n)
            nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            label = _forest(at[:len(a)], at[len(a):], len(nodes))
            k = np.flatnonzero(label != np.arange(len(nodes)))
            yield pd.DataFrame({"cid": np.concatenate([seen, nodes[k]]), "linked": np.concatenate([total, np.zeros(len(k), np.int64)]),
                                "other": np.concatenate([seen, nodes[label[k]]])})

    packed = scratch.keep(homes.mapInPandas(place, "cid long, copies long, cell long, x binary, block long").groupBy("block").applyInPandas(
        pack, "block long, cell long, near array<long>, cids binary, copies binary, x binary"), row_group=16 << 20)
    scratch.drop(homes)
    prepare(spark, ARROW_PAIRS)
    parts = max(-(-n_blocks // max(1, MEMBER_BLOCK // HOME_BLOCK)), min(n_blocks, math.isqrt(2 * spark.sparkContext.defaultParallelism) + 1), 1)
    dealt = packed.repartition(parts)
    other = dealt.toDF(*[c + "2" for c in packed.columns]).hint("shuffle_replicate_nl")
    # Each two blocks once, from either side in turn, so that no task has all pairs of its two sides and another none.
    once = (F.col("block") == F.col("block2")) | ((F.col("block") < F.col("block2")) == ((F.col("block") + F.col("block2")) % 2 == 0))
    # Both sides read the same columns, so they are one exchange.
    meets = F.array_contains("near", F.col("cell2")) & F.array_contains("near2", F.col("cell"))
    pairs = dealt.join(other, once & meets).drop("near", "near2")
    found = scratch.keep(pairs.mapInPandas(compare, "cid long, linked long, other long"))
    scratch.drop(packed)
    prepare(spark)
    return found, found.filter("cid <> other").select(F.col("cid").alias("a"), F.col("other").alias("b"))
