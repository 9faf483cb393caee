"""N-gram Jaccard join by vertical partitioning of a global n-gram order.

The global order puts rare shingles before frequent ones: shingles that occur in
few documents stand first, by hash, then the frequent ones by their number.
Two sets with Jaccard >= t share a shingle among the first n - ceil(t n) + 1 of
each in that order (its prefix), so only documents that meet there can link;
for given sizes the shared one stands before n - ceil(t / (1 + t) (n + m)) + 1.
Candidates are then decided by vertical partitioning: the order is cut into
fragments, the rare shingles by hash, the frequent ones as the last, every set into one segment per fragment, overlaps are counted per
pair and fragment, and the partial counts are summed per pair.

What is wanted is the groups, so no group is expanded into its pairs.  Equal
sets are one node.  In each bucket of a prefix shingle the nodes are first tried
against one node of the bucket only; once components are known, only nodes of
different components that share enough of their prefixes to be able to link are
tried.  No link between different components can be missed, and nothing is
capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, components, maybe_member, prepare

FLUSH = 1_000_000        # shingles a task gathers before it writes them out
FREQUENT = 8             # a shingle that occurs less often is never frequent
MOST_FREQUENT = 1 << 20  # at most so many frequent shingles are known to all tasks
FRAGMENTS = 8            # of the global order, the last for frequent shingles
HUB_ROUNDS = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
# Odd factors of a word by its place in a shingle, from one multiplicative rule.
_FACTORS = np.multiply.accumulate(np.full(64, 0xD1342543DE82EF95, np.uint64))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles: A-Z lowered,
    words cut at ASCII white space; a shorter text is one shingle, none without words.

    A shingle is the sum of its words' hashes, each times the factor of its place,
    mixed once."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, width)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h += w[i:n - k + 1 + i] * _FACTORS[i]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return np.unique(h)


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32)


def _pack(cells: np.ndarray, start: int) -> bytes:
    """Sorted 32-bit numbers as 16-bit steps; 65535 is a step without a number."""
    steps = np.diff(cells.astype(np.int64), prepend=start)
    wide = steps // 65535
    if wide.any():
        out = np.full(int((wide + 1).sum()), 65535, np.uint16)
        out[np.cumsum(wide + 1) - 1] = steps % 65535
        return out.tobytes()
    return steps.astype(np.uint16).tobytes()


def _unpack(blob: bytes, start: int) -> np.ndarray:
    steps = np.frombuffer(blob, np.uint16)
    return (np.cumsum(steps.astype(np.int64)) + start)[steps != 65535]


class FrequentFirst:
    """The frequent cells and their place behind all others in the order."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray):
        order = np.argsort(cells)
        self.cells, self.counts = cells[order].astype(np.uint32), counts[order].astype(np.int64)

    def count(self, h: np.ndarray) -> np.ndarray:
        """Occurrences of the shingles that are frequent, 0 for the others."""
        if not len(self.cells):
            return np.zeros(len(h), np.int64)
        c = _cells(h)
        at = np.minimum(np.searchsorted(self.cells, c), len(self.cells) - 1)
        return np.where(self.cells[at] == c, self.counts[at], 0)

    def prefix(self, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``size`` shingles in the order: the rare and the frequent ones."""
        often = self.count(h)
        rare = h[often == 0][:size]
        if len(rare) == size:
            return rare, h[:0]
        common = often > 0
        rest = h[common][np.lexsort((h[common], often[common]))]
        return rare, rest[:size - len(rare)]

    def fragments(self, h: np.ndarray) -> list[np.ndarray]:
        """Segments of a sorted set by the order: the rare shingles by equal ranges
        of the hash, the frequent ones in the last."""
        often = self.count(h) > 0
        rare = h[~often]
        edges = np.searchsorted(rare, [np.uint64((k << 64) // (FRAGMENTS - 1)) for k in range(1, FRAGMENTS - 1)])
        return [*np.split(rare, edges), h[often]]


def _count_cells(docs: DataFrame, width: int, ranges: int) -> DataFrame:
    """Occurrences of all shingle cells; returns ``cell, n`` of those with
    ``FREQUENT`` or more, and a row ``-1, occurrences`` per range."""
    def emit(batches):
        held, size = [], 0

        def flush():
            cells = np.sort(np.concatenate([_cells(h) for h in held]))
            r = (cells.astype(np.uint64) * np.uint64(ranges)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(r)) + 1
            parts = np.split(cells, cuts)
            at = r[np.concatenate([[0], cuts])].astype(int)
            return pd.DataFrame({"r": at, "cells": [_pack(p, -(-(int(k) << 32) // ranges)) for k, p in zip(at, parts)]})

        for batch in batches:
            for text in batch.iloc[:, 0]:
                h = shingles(text, width)
                if len(h):
                    held.append(h)
                    size += len(h)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        start = -(-(int(group["r"].iloc[0]) << 32) // ranges)
        cells = np.concatenate([_unpack(b, start) for b in group["cells"]])
        total = len(cells)
        cells, n = np.unique(cells, return_counts=True)
        often = n >= FREQUENT
        return pd.DataFrame({"cell": np.append(cells[often], -1), "n": np.append(n[often], total)})

    return docs.select("__text").mapInPandas(emit, "r long, cells binary").groupBy("r").applyInPandas(add_up, "cell long, n long")


def _prefixes(docs: DataFrame, width: int, threshold: tuple[int, int], order, ranges: int) -> DataFrame:
    """One pass that writes a row per text (kind ``text``) and its prefix shingles
    in packed rows: kind ``rare`` by range of the cell, kind ``common``."""
    num, den = threshold

    def emit(batches):
        blank = {"kind": None, "rid": None, "doc": None, "digest": None, "n": None, "twice": None, "often": None, "r": None, "cells": None, "rows": None, "places": None}

        def frame(columns):
            out = pd.DataFrame({**blank, **columns}, columns=list(blank))
            for c in ("rid", "doc", "n", "twice", "often", "r"):
                out[c] = out[c].astype("Int64")
            return out

        def flush(base, texts, rare, common):
            yield frame({"kind": "text", **{k: [t[i] for t in texts] for i, k in enumerate(("rid", "doc", "digest", "n", "twice", "often"))}})
            for kind, held in (("rare", rare), ("common", common)):
                if not held:
                    continue
                cells, places = (np.concatenate([x[k] for x in held]) for k in (1, 2))
                rows = np.repeat(np.array([x[0] for x in held], np.uint16), [len(x[1]) for x in held])
                by = np.argsort(cells, kind="stable")
                cells, rows, places = cells[by], rows[by], places[by]
                r = ((cells.astype(np.uint64) * np.uint64(ranges)) >> np.uint64(32)).astype(int)
                cuts = np.flatnonzero(np.diff(r)) + 1
                yield frame({"kind": kind, "rid": base, "r": r[np.concatenate([[0], cuts])],
                             **{name: [c.tobytes() for c in np.split(x, cuts)] for name, x in (("cells", cells), ("rows", rows), ("places", places))}})

        known, texts, rare, common, size, base = order.value, [], [], [], 0, None
        for batch in batches:
            for rid, doc, text in zip(batch.iloc[:, 0], batch.iloc[:, 1], batch.iloc[:, 2]):
                h = shingles(text, width)
                n = len(h)
                rid = int(rid)
                if base is not None and not 0 <= rid - base < 1 << 16:  # the next file of several in a partition
                    yield from flush(base, texts, rare, common)
                    texts, rare, common, size, base = [], [], [], 0, None
                base = rid if base is None else base
                doc = None if pd.isna(doc) else int(doc)
                if not n:
                    texts.append((rid, doc, None, 0, 0, 0))
                else:
                    p = n - -(-num * n // den) + 1
                    few, many = known.prefix(h, p)
                    distinct = 0
                    for kind, part, first in ((rare, few, 0), (common, many, len(few))):
                        if len(part):
                            cells, place = np.unique(_cells(part), return_index=True)
                            kind.append((rid - base, cells, np.minimum(place + first, 65535).astype(np.uint16)))
                            distinct += len(cells)
                    texts.append((rid, doc, xxhash.xxh3_128_digest(h.tobytes()), n, p - distinct, len(many)))
                    size += p
                if size >= FLUSH // 2 or len(texts) >= 50_000:
                    yield from flush(base, texts, rare, common)
                    texts, rare, common, size, base = [], [], [], 0, None
        if texts:
            yield from flush(base, texts, rare, common)

    return docs.select("__rid", "__doc", "__text").mapInPandas(
        emit, "kind string, rid long, doc long, digest binary, n long, twice long, often long, r long, cells binary, rows binary, places binary")


def _opened(packed: pd.DataFrame) -> pd.DataFrame:
    """The entries of packed rows: ``cell, rid, place`` in the order."""
    cells = [np.frombuffer(b, np.uint32) for b in packed["cells"]]
    return pd.DataFrame({
        "cell": np.concatenate(cells).astype(np.int64),
        "rid": np.concatenate([np.frombuffer(b, np.uint16).astype(np.int64) + base for base, b in zip(packed["rid"], packed["rows"])]),
        "place": np.concatenate([np.frombuffer(b, np.uint16) for b in packed["places"]]).astype(np.int32)})


_ENTRY = "cell long, rid long, place int"


def _shared_rare(packed: DataFrame) -> DataFrame:
    """Entries of the rare prefix cells that two texts or more hold.

    Grouped by range of the cell: a rare cell has few rows, so ranges are even."""
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        found = _opened(group).sort_values("cell", kind="stable")
        same = np.diff(found["cell"].to_numpy()) == 0
        return found[np.append(same, False) | np.insert(same, 0, False)]

    return packed.select("r", "rid", "cells", "rows", "places").groupBy("r").applyInPandas(meet, _ENTRY)


def _unfolded(packed: DataFrame) -> DataFrame:
    """All entries of packed rows, a row each."""
    def unfold(batches):
        for batch in batches:
            for k in range(len(batch)):
                yield _opened(batch.iloc[k:k + 1])

    return packed.select("rid", "cells", "rows", "places").mapInPandas(unfold, _ENTRY)


class JaccardGroups:
    """The steps of :func:`jaccard_groups`, over one input.

    With ``numbered`` the rows are written once with their numbers: these depend
    on how files are packed into partitions, so a later plan over the same files
    can number other rows.  Without, numbers hold within the groups only."""

    def __init__(self, docs: DataFrame, width: int, threshold: tuple[int, int], text: str, id: str, numbered: bool = False):
        self.spark = docs.sparkSession
        prepare(self.spark)
        self.scratch = Scratch(self.spark, "ngrams")
        # Rows of one partition have consecutive ids, so packed rows hold differences.
        rows = docs.withColumn("__rid", F.monotonically_increasing_id())
        self.rows = self.scratch.keep(rows) if numbered else rows
        self.docs = self.rows.select("__rid", F.col(id).cast("long").alias("__doc"), F.col(text).alias("__text"))
        self.width, self.threshold = width, threshold

    def order(self):
        """Broadcast order, and the number of shingle occurrences."""
        ranges = max(64, 8 * self.docs.rdd.getNumPartitions())
        counted = self.scratch.keep(_count_cells(self.docs, self.width, ranges))
        total = counted.filter("cell < 0").agg(F.sum("n")).first()[0] or 0
        # The least count that leaves a list within the bound; total / MOST_FREQUENT always does.
        most = 1 << 16
        sizes = counted.filter("cell >= 0").groupBy(F.least("n", F.lit(most)).alias("n")).agg(F.count("*").alias("cells")).collect()
        least, listed = max(FREQUENT, -(-total // MOST_FREQUENT)), 0
        for n, cells in sorted(((r["n"], r["cells"]) for r in sizes), reverse=True):
            listed += cells
            if listed > MOST_FREQUENT:
                break
            least = min(least, n) if n < most else least
        often = counted.filter((F.col("cell") >= 0) & (F.col("n") >= least)).toPandas()
        self.scratch.drop(counted)
        return self.spark.sparkContext.broadcast(FrequentFirst(often["cell"].to_numpy(), often["n"].to_numpy())), total

    def near(self, n, place, m):
        """Whether an entry of a set of ``n`` at ``place`` can be the first that it
        shares with a set of ``m`` that reaches the threshold."""
        num, den = self.threshold
        return (num + den) * (n - place) >= num * (n + m)

    def enough(self, shared):
        """Whether a pair with ``shared`` common prefix cells can reach the threshold:
        beyond the prefix that ends first, all shingles of its text may be common."""
        num, den = self.threshold
        nx, ny = F.col("nx"), F.col("ny")
        behind = F.greatest(*[F.ceil(n * num / den) - 1 for n in (nx, ny)])
        return (num * F.greatest(nx, ny) <= den * F.least(nx, ny)) & ((shared + F.least("tx", "ty") + behind) * (num + den) >= num * (nx + ny))

    def run(self) -> tuple[DataFrame, DataFrame]:
        """``(texts, groups)``: rid, doc, node, n; node, component node."""
        num, den = self.threshold
        keep = self.scratch.keep
        order, total = self.order()
        self.known = order
        ranges = max(16, total // (FLUSH // 2))
        written = keep(_prefixes(self.docs, self.width, self.threshold, order, ranges), by="kind")
        texts = written.filter("kind = 'text'").select("rid", "doc", "digest", "n", "twice", "often")
        classes = texts.filter("n > 0").groupBy("digest").agg(F.min("rid").alias("node"))
        texts = keep(texts.join(classes, "digest", "left").withColumn("node", F.coalesce("node", "rid")))
        nodes = texts.filter("rid = node AND n > 0").select("node", "n", "twice", "often", "doc", "digest")
        # Copies have one prefix, so the entries of one row of each set are enough.
        entries = (_shared_rare(written.filter("kind = 'rare'")).withColumn("common", F.lit(False))
                   .unionAll(_unfolded(written.filter("kind = 'common'")).withColumn("common", F.lit(True))))
        entries = self._live(keep(entries.withColumnRenamed("rid", "node").join(nodes.select("node", "n", "twice", "often"), "node")))
        self.scratch.drop(written)

        tried = groups = None
        for _ in range(HUB_ROUNDS):
            marked = self._open_buckets(entries, groups)
            hubs = marked.groupBy("cell").agg(F.min(F.struct("place", "node", "group", "n", "twice", "often")).alias("hub"))
            best = (self._candidates(marked.join(hubs, "cell").filter("group <> hub.group").select(
                        F.col("node").alias("x"), F.col("hub.node").alias("y"), F.col("n").alias("nx"), F.col("hub.n").alias("ny"),
                        F.col("place").alias("ax"), F.col("hub.place").alias("ay"), F.col("twice").alias("tx"), F.col("hub.twice").alias("ty"),
                        F.col("often").alias("ox"), F.col("hub.often").alias("oy"), "common"))
                    .groupBy("x").agg(F.max(F.struct("shared", (-F.col("y")).alias("y"), "nx", "ny")).alias("b"))
                    .select("x", (-F.col("b.y")).alias("y"), "b.nx", "b.ny"))
            tried, groups = self._try(best, nodes, tried, groups)
        marked = self._open_buckets(entries, groups)
        named = (("group", "g"), ("n", "n"), ("place", "a"), ("twice", "t"), ("often", "o"))
        a, b = (marked.select("cell", "common", *[F.col(c).alias(d + side) for c, d in named], F.col("node").alias(side)) for side in "xy")
        b = b.drop("common")
        left = self._candidates(a.join(b, "cell").filter("gx < gy")).select("x", "y", "nx", "ny")
        known = tried.select("x", "y").unionAll(tried.select(F.col("y").alias("x"), F.col("x").alias("y")))
        _, groups = self._try(left.join(known, ["x", "y"], "left_anti"), nodes, tried, groups)
        return texts, groups

    def _live(self, entries: DataFrame) -> DataFrame:
        """Entries of the nodes that stand early enough in some bucket to link with
        its smallest set, in buckets where two of these meet; of frequent shingles,
        which have large buckets, only the entries that do."""
        num, den = self.threshold
        met = entries.groupBy("cell").agg(F.min("n").alias("least"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
        near = self.near(F.col("n"), F.col("place"), F.greatest("least", F.ceil(F.col("n") * num / den)))
        marked = entries.join(met, "cell").withColumn("near", near).drop("least", "lo", "hi")
        nodes = marked.filter("near").select("node").distinct()
        live = marked.filter("near OR NOT common").drop("near").join(nodes, "node", "left_semi")
        met = live.groupBy("cell").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("cell")
        kept = self.scratch.keep(live.join(met, "cell", "left_semi"))
        self.scratch.drop(entries)
        return kept

    def _open_buckets(self, entries: DataFrame, groups: DataFrame | None) -> DataFrame:
        """Entries with ``group``, of the buckets that hold nodes of several groups."""
        if groups is None:
            return entries.withColumn("group", F.col("node"))
        marked = (entries.join(groups.withColumnRenamed("id", "node"), "node", "left")
                  .withColumn("group", F.coalesce("component_id", "node")).drop("component_id"))
        mixed = marked.groupBy("cell").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("cell")
        return marked.join(mixed, "cell", "left_semi")

    def _candidates(self, met: DataFrame) -> DataFrame:
        """Pairs of a join of entries that can link, with the entries they share.

        All shared rare entries are counted.  Of the frequent ones, those that can
        come first make a pair; the others are not looked at but taken as shared.
        """
        near = self.near(F.col("nx"), F.col("ax"), F.col("ny")) & self.near(F.col("ny"), F.col("ay"), F.col("nx"))
        num, den = self.threshold
        fits = num * F.greatest("nx", "ny") <= den * F.least("nx", "ny")
        return (met.filter(fits & (near | ~F.col("common"))).groupBy("x", "y", "nx", "ny", "tx", "ty", "ox", "oy")
                .agg(F.count("*").alias("shared"), F.count_if(~F.col("common")).alias("rare"), F.max(near).alias("near"))
                .filter(F.col("near") & self.enough(F.col("rare") + F.least("ox", "oy"))))

    def _try(self, pairs: DataFrame, nodes: DataFrame, tried: DataFrame | None, groups: DataFrame | None):
        """Decides pairs (x, y, nx, ny); returns all pairs tried and the components."""
        num, den = self.threshold
        pairs = self.scratch.keep(pairs)
        tried = pairs if tried is None else tried.unionAll(pairs)
        if groups is not None and pairs.isEmpty():
            return tried, groups
        links = (self._overlaps(pairs, nodes).filter((num + den) * F.col("both") >= num * (F.col("nx") + F.col("ny")))
                 .select(F.col("x").alias("a"), F.col("y").alias("b")))
        if groups is not None:  # what is known joins as one edge per node
            links = links.unionAll(groups.select(F.col("id").alias("a"), F.col("component_id").alias("b")))
        return tried, components(self.spark, links, self.scratch)

    def _overlaps(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Overlap of each pair: partial counts per fragment, summed per pair."""
        wanted = self.scratch.keep(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(nodes.select("node", "doc", "digest"), "node"))
        flagged = maybe_member(self.docs, "__doc", wanted.select(F.col("doc").alias("__doc")), "__wanted", wanted.count())
        width, order = self.width, self.known

        def cut(batches):
            for batch in batches:
                rows = []
                for text in batch.iloc[:, 0]:
                    h = shingles(text, width)
                    if len(h):
                        digest = xxhash.xxh3_128_digest(h.tobytes())
                        rows += [(digest, k, s.view(np.int64)) for k, s in enumerate(order.value.fragments(h)) if len(s)]
                yield pd.DataFrame(rows, columns=["digest", "fragment", "segment"])

        cut_texts = flagged.filter("__wanted").select("__text").mapInPandas(cut, "digest binary, fragment int, segment array<long>")
        segments = self.scratch.keep(cut_texts.join(wanted.select("node", "digest"), "digest").select("node", "fragment", "segment"))
        left = pairs.join(segments.select(F.col("node").alias("x"), "fragment", F.col("segment").alias("sx")), "x")
        met = left.join(segments.select(F.col("node").alias("y"), "fragment", F.col("segment").alias("sy")), ["y", "fragment"])
        # A text that stands in several rows gives the same count again: the maximum is one of them.
        partial = (met.select("x", "y", "nx", "ny", "fragment", F.size(F.array_intersect("sx", "sy")).alias("part"))
                   .groupBy("x", "y", "nx", "ny", "fragment").agg(F.max("part").alias("part")))
        return partial.groupBy("x", "y", "nx", "ny").agg(F.sum("part").alias("both"))


def jaccard_groups(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (4, 5), text: str = "text", id: str = "doc_id") -> DataFrame:
    """Groups of texts linked by Jaccard >= ``threshold`` of their word shingles:
    ``id, n_shingles long, component_id long``, one row per input row.

    The component is the smallest id reachable by links, the row's own included.
    Null or empty texts and texts of white space have no shingles and are linked
    with nothing, not even with each other.  Rows with equal sets, repeated rows
    among them, are linked.  A null id stays null and is passed over where a
    smallest id is sought.  An empty table gives an empty table.
    """
    texts, groups = JaccardGroups(docs, width, threshold, text, id).run()
    placed = texts.join(groups.withColumnRenamed("id", "node"), "node", "left").withColumn("group", F.coalesce("component_id", "node"))
    least = placed.groupBy("group").agg(F.min("doc").alias("least"))
    return placed.join(least, "group").select(F.col("doc").alias(id), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def drop_copies(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (4, 5), text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, and of equal
    ids the first row.  Rows without shingles all stay.

    Rows that may have to go are picked out by a bitmap; only they meet the
    exact list, so the texts of all others are not shuffled.  Columns may have any
    names: they are renamed by position in between.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    join = JaccardGroups(plain, width, threshold, f"c{names.index(text)}", f"c{names.index(id)}", numbered=True)
    texts, groups = join.run()
    placed = join.scratch.keep(texts.join(groups.withColumnRenamed("id", "node"), "node", "left")
                               .select("rid", "doc", F.coalesce("component_id", "node").alias("group")))
    first = placed.groupBy("group").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "rid")).alias("first"))
    gone = join.scratch.keep(placed.join(first, "group").filter("rid <> first.rid").select(F.col("rid").alias("__rid")))
    flagged = maybe_member(join.rows, "__rid", gone, "__maybe", gone.count())
    sure = flagged.filter(~F.col("__maybe"))
    checked = flagged.filter("__maybe").join(gone, "__rid", "left_anti")
    return sure.select(*plain.columns).unionAll(checked.select(*plain.columns)).toDF(*names)
