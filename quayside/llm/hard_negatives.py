"""Hard negatives by zone maps over Hilbert-ordered blocks.

Candidates are sorted along a Hilbert curve and written to Parquet in blocks of
rows that lie near each other, each with the least and greatest value of every
dimension.  Interval arithmetic on these bounds the score that an anchor can
reach in a block from both sides, so a window of scores names the blocks that
have to be read.  An anchor's own block is read first; what it finds raises the
bound that others have to reach.

The anchors are the stated query set.  Groups of anchors meet pages of zone
maps, then only the blocks that some of them need.  No list of rows, blocks or
anchors comes to the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, prepare, ranked

BLOCK_ROWS = 512     # candidates of one block
SPAN_BLOCKS = 32     # blocks whose anchors are one group
PAGE_BLOCKS = 256    # zone maps of one page
PAGE_GROUPS = 64     # groups of anchors that meet a page in one task
CURVE_BITS = 4       # of each dimension on the curve
ARROW_BLOCKS = 32    # blocks in one Arrow batch

LEAST, MOST = -(1 << 62), 1 << 62  # no bound on a score


def hilbert_key(grid: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of ``grid`` (whole numbers under 2^``bits``) on the Hilbert
    curve through all dimensions, as bytes that sort like it.

    Gray-code form: from the highest bit down, an axis whose bit is set flips the
    lower bits of the first axis, one whose bit is not set trades them with it;
    the bits, Gray-decoded, are read dimension by dimension.
    """
    x = grid.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = (one << np.uint64(level)) - one
        for axis in range(len(x)):
            is_set = (x[axis] >> np.uint64(level)) & one != 0
            trade = np.where(is_set, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(is_set, low, trade)
            x[axis] ^= trade
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & one != 0, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= turn
    planes = [((x >> np.uint64(level)) & one).astype(np.uint8) for level in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(planes).T, axis=1)]


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in double precision while every sum
    stays under 2^53, in Python's integers beyond."""
    if not anchors.size or not rows.size or np.abs(anchors).max() * np.abs(rows).max() * anchors.shape[1] < 2.0 ** 53:
        return (anchors @ rows.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    out = exact(anchors) @ exact(rows).T
    return np.clip(out, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have in each zone."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least, most = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    slack = 1 + 1e-9 * np.maximum(np.abs(least), np.abs(most))  # rounding of sums past 2^53
    return least - slack, most + slack


def _table(blob, kind="<i8") -> np.ndarray:
    return np.frombuffer(blob, kind)


def _matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(-1, dim)


def _first(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best scores, falling; of equal ones the first places."""
    if len(scores) > 4 * most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
        return at[np.argsort(-scores[at], kind="stable")][:most]
    return np.argsort(-scores, kind="stable")[:most]


class _Block:
    """A block's candidates, ordered by id and then by row, so that the first of
    equal scores is the one wanted."""

    def __init__(self, row):
        rids, ids, labels, x = _table(row.rids), _table(row.ids), _table(row.labels), _matrix([row.x], row.dim)
        order = np.lexsort((rids, ids))
        self.rids, self.ids, self.labels, self.x = rids[order], ids[order], labels[order], x[order]
        self.anchor = _table(row.anchors, "?")[order]


class _Found:
    """Columns of the rows found, gathered."""

    def __init__(self):
        self.parts: list[tuple] = []

    def add(self, anchor, slot: int, scores: np.ndarray, block: _Block, at: np.ndarray) -> None:
        if len(at):
            self.parts.append((anchor["rid"], anchor["id"], slot, scores[at], block.ids[at], block.rids[at]))

    def frame(self) -> pd.DataFrame:
        n = [len(p[3]) for p in self.parts]
        some = lambda k: np.repeat(np.array([p[k] for p in self.parts], np.int64), n)
        every = lambda k: np.concatenate([p[k] for p in self.parts]) if n else np.zeros(0, np.int64)
        return pd.DataFrame({"rid": some(0), "id": some(1), "slot": some(2), "score": every(3), "other": every(4), "other_rid": every(5)})


_FOUND = "rid long, id long, slot long, score long, other long, other_rid long"


class HardNegatives:
    """The steps of :func:`mine_hard_negatives` over one input."""

    def __init__(self, vectors: DataFrame, is_anchor: Column, vector: str, id: str, label: str, positives: int, negatives: int,
                 low_percent: int, high_percent: int):
        self.spark = vectors.sparkSession
        prepare(self.spark)
        self.scratch = Scratch(self.spark, "negatives")
        self.positives, self.negatives, self.low, self.high = positives, negatives, low_percent, high_percent
        scaled = F.transform(vector, lambda v: v.cast("double") * 256)
        infinite = F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        self.rows = (vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled.alias("v"),
                                    F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
                     .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce((F.size("v") > 0) & ~infinite, F.lit(False))))

    def blocks(self) -> DataFrame:
        """Candidates in the order of the curve, a row per block with its zone map."""
        # The grid: two numbers per dimension and vector length.
        spread = self.rows.select(F.size("v").alias("dim"), F.posexplode("v").alias("axis", "x")).groupBy("dim", "axis").agg(
            F.min("x").alias("low"), F.max("x").alias("high"))
        grid = (spread.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("g"))
                .select("dim", F.col("g.low").alias("low"), F.col("g.high").alias("high")))
        top = (1 << CURVE_BITS) - 1

        def curve(batches):
            for batch in batches:
                for dim, part in batch.groupby("dim"):
                    x = np.floor(np.stack(part["v"].to_numpy()).astype("<f8"))
                    low, high = (np.floor(np.asarray(part[c].iloc[0], "<f8")) for c in ("low", "high"))
                    place = np.clip(np.round((x - low) / np.where(high > low, high - low, 1) * top), 0, top)
                    yield pd.DataFrame({"id": part["id"].to_numpy(), "label": part["label"].to_numpy(), "anchor": part["anchor"].to_numpy(),
                                        "dim": dim, "key": hilbert_key(place, CURVE_BITS), "x": [r.tobytes() for r in x]})

        placed = self.scratch.keep(self.rows.withColumn("dim", F.size("v")).join(grid, "dim").mapInPandas(
            curve, "id long, label long, anchor boolean, dim int, key binary, x binary"))
        order = ranked(placed, ["key", "id", "label", "x"], self.scratch, within="dim")
        cut = order.select("dim", F.expr(f"shiftleft(CAST(dim AS BIGINT), 40) + __rank div {BLOCK_ROWS}").alias("block"),
                           (F.col("__rank") % BLOCK_ROWS).alias("slot"), "id", "label", "anchor", "x")

        def pack(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("slot")
            dim, block = int(group["dim"].iloc[0]), int(group["block"].iloc[0])
            x = _matrix(group["x"], dim)
            whole = {"rids": block * BLOCK_ROWS + group["slot"], "ids": group["id"], "labels": group["label"]}
            return pd.DataFrame({"block": [block], "dim": [dim], "x": [x.tobytes()], "low": [x.min(0).tobytes()], "high": [x.max(0).tobytes()],
                                 "anchors": [group["anchor"].to_numpy(bool).tobytes()],
                                 **{c: [v.to_numpy("<i8").tobytes()] for c, v in whole.items()}})

        return self.scratch.keep(cut.groupBy("block").applyInPandas(
            pack, "block long, dim int, x binary, low binary, high binary, anchors binary, rids binary, ids binary, labels binary"))

    def run(self) -> DataFrame:
        keep = self.scratch.keep
        blocks = self.blocks()
        prepare(self.spark, ARROW_BLOCKS)
        most, few = self.positives, self.negatives

        def own(batches):
            """The anchors of each block, with the score of their last positive in it."""
            for batch in batches:
                for row in batch.itertuples():
                    b = _Block(row)
                    at = np.flatnonzero(b.anchor)
                    scores, seeds = products(b.x[at], b.x), []
                    for k, a in enumerate(at):
                        same = scores[k][(b.labels == b.labels[a]) & (b.rids != b.rids[a])]
                        seeds.append(np.sort(same)[-most] if len(same) >= most else LEAST)
                    yield pd.DataFrame({"home": row.block, "dim": row.dim, "rid": b.rids[at], "id": b.ids[at], "label": b.labels[at],
                                        "x": [r.tobytes() for r in b.x[at]], "floor": np.array(seeds, np.int64)})

        def same_label(a, block, scores, found):
            same = np.flatnonzero((block.labels == a["label"]) & (block.rids != a["rid"]) & (scores >= a["floor"]))
            found.add(a, 0, scores, block, same[_first(scores[same], most)])

        def in_windows(a, block, scores, found):
            other = np.flatnonzero((block.labels != a["label"]) & (scores >= a["floor"]) & (scores <= a["ceiling"]))
            other = other[np.argsort(-scores[other], kind="stable")]
            falling = -scores[other]
            for w in a["windows"]:
                first = np.searchsorted(falling, -w["high"], "left")
                found.add(a, w["slot"], scores, block, other[first:min(first + few, np.searchsorted(falling, -w["low"], "right"))])

        no_windows = F.array().cast("array<struct<slot:bigint,low:bigint,high:bigint>>")
        anchors = keep(blocks.mapInPandas(own, "home long, dim int, rid long, id long, label long, x binary, floor long")
                       .withColumn("span", F.expr(f"home div {SPAN_BLOCKS}")))
        groups = self._grouped(anchors.withColumn("ceiling", F.lit(MOST)).withColumn("windows", no_windows))
        best = Window.partitionBy("rid").orderBy(F.desc("score"), "other", "other_rid")
        positives = keep(self._read(groups, self._needed(groups, blocks), blocks, same_label)
                         .withColumn("slot", F.row_number().over(best).cast("long")).filter(F.col("slot") <= most))

        # A negative score has no window: its lower end lies above its upper one.
        low, high = (F.expr(f"(CAST(score AS DECIMAL(20,0)) * {p} + {up}) div 100") for p, up in ((self.low, 99), (self.high, 0)))
        ends = positives.filter("score >= 0").select("rid", F.struct("slot", low.alias("low"), high.alias("high")).alias("w")).filter("w.low <= w.high")
        windows = ends.groupBy("rid").agg(F.array_sort(F.collect_list("w")).alias("windows"))  # at most ``positives`` for an anchor
        asked = keep(anchors.drop("floor").join(windows, "rid"))
        # The own block first: where it fills a window, nothing under its last score is wanted.
        at_home = self._read(self._grouped(self._framed(asked)), self._homes(asked), blocks, in_windows)
        filled = (at_home.groupBy("rid", "slot").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == few)
                  .groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("slot", "least"))).alias("known")))
        raised = F.transform("windows", lambda w: F.struct(
            w["slot"].alias("slot"), F.coalesce(F.try_element_at("known", w["slot"]), w["low"]).alias("low"), w["high"].alias("high")))
        groups = self._grouped(self._framed(asked.join(filled, "rid", "left").withColumn("windows", raised)))
        top = Window.partitionBy("rid", "slot").orderBy(F.desc("score"), "other", "other_rid")
        negatives = keep(self._read(groups, self._needed(groups, blocks), blocks, in_windows)
                         .withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= few)
                         .select("rid", "slot", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score")))
        prepare(self.spark)
        named = positives.select("rid", "slot", F.col("id").alias("anchor_id"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
        return negatives.join(named, ["rid", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

    @staticmethod
    def _framed(asked: DataFrame) -> DataFrame:
        """With the least and greatest score that any window of an anchor holds."""
        return asked.withColumn("floor", F.array_min("windows.low")).withColumn("ceiling", F.array_max("windows.high"))

    def _grouped(self, anchors: DataFrame) -> DataFrame:
        """A row per group of anchors, those of ``SPAN_BLOCKS`` blocks."""
        one = F.struct("rid", "id", "label", "x", "floor", "ceiling", "windows")
        return self.scratch.keep(anchors.groupBy("span", "dim").agg(F.array_sort(F.collect_list(one)).alias("a")))

    def _homes(self, anchors: DataFrame) -> DataFrame:
        """Each group with the blocks that its anchors stand in."""
        return anchors.groupBy("span", F.col("home").alias("block")).agg(F.collect_list("rid").alias("wanted"))

    def _needed(self, groups: DataFrame, blocks: DataFrame) -> DataFrame:
        """The blocks that each group has to read, and for which of its anchors:
        groups meet pages of zone maps, in tasks of a bounded size."""
        page = F.expr(f"block div {PAGE_BLOCKS}")
        zones = blocks.select("dim", "block", "low", "high", page.alias("page"))
        span_pages = zones.groupBy("dim").agg(F.min("page").alias("first"), F.max("page").alias("last"))  # pages have no gaps
        shards = max(1, -(-groups.count() // PAGE_GROUPS))
        pages = (zones.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("block", "low", "high"))).alias("zones"))
                 .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
        spread = (groups.join(span_pages, "dim").withColumn("page", F.explode(F.sequence("first", "last")))
                  .withColumn("shard", F.pmod("span", F.lit(shards)).cast("int")))

        def needed(batches):
            for batch in batches:
                for row in batch.itertuples():
                    a = _matrix([r["x"] for r in row.a], row.dim)
                    rids = np.array([r["rid"] for r in row.a])
                    least, most = bounds(a, *(_matrix([z[c] for z in row.zones], row.dim) for c in ("low", "high")))
                    floor, ceiling = (np.array([r[c] for r in row.a], float)[:, None] for c in ("floor", "ceiling"))
                    wanted = (most >= floor) & (least <= ceiling)
                    at = np.flatnonzero(wanted.any(0))
                    yield pd.DataFrame({"span": row.span, "block": [row.zones[k]["block"] for k in at], "wanted": [rids[wanted[:, k]] for k in at]})

        return self.scratch.keep(spread.join(pages, ["page", "shard"]).select("span", "dim", "a", "zones").mapInPandas(
            needed, "span long, block long, wanted array<long>"))

    def _read(self, groups: DataFrame, pairs: DataFrame, blocks: DataFrame, look) -> DataFrame:
        """Applies ``look`` to the wanted anchors of each group and each block it reads."""
        def read(batches):
            for batch in batches:
                found = _Found()
                for row in batch.itertuples():
                    block, wanted = _Block(row), set(row.wanted)
                    anchors = [a for a in row.a if a["rid"] in wanted]
                    for a, scores in zip(anchors, products(_matrix([a["x"] for a in anchors], row.dim), block.x)):
                        look(a, block, scores, found)
                yield found.frame()

        met = pairs.join(groups.drop("dim"), "span").join(blocks.drop("low", "high"), "block")
        return self.scratch.keep(met.select("a", "wanted", "dim", "x", "anchors", "rids", "ids", "labels").mapInPandas(read, _FOUND))


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, vector: str = "embedding", id: str = "vec_id", label: str = "label",
                        positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """For each anchor and each of its first ``positives`` other rows of its label,
    the first ``negatives`` rows of another label whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's: ``anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of the vectors' parts as whole numbers,
    floor(256 x); higher ones come first, then smaller ids, of equal ids one row
    after the other.  Scores are exact; those past 64 bits count as the largest
    64-bit number.  Rows with a null id, label or vector, an empty vector, or a
    part that is null or not finite (256 times it included) take no part.
    Vectors of different lengths do not meet.  Repeated rows are rows of their
    own, each an anchor if its id says so.  An empty table gives an empty one;
    other columns are not read.  Every block that can hold a wanted row is read.
    """
    return HardNegatives(vectors, is_anchor, vector, id, label, positives, negatives, low_percent, high_percent).run()
