"""Phrase collocations by SETM: mining with sorted relations, joins and counts.

R_k is the relation of occurrences of k-word phrases, (place, phrase) sorted by
place.  A place numbers a word within its piece and the piece within its block
of texts: pieces are a place apart, so two places that follow each other lie in
one piece.  R_k is merge-joined with itself on adjacent places, which gives the
occurrences of the (k+1)-word phrases; these are group-counted, the occurrences
of frequent ones are kept by a semi-join and persisted as R_(k+1).

A phrase is named by 64 bits made of the names of its two parts one word
shorter.  The parts are kept beside the count, so names are looked up by joins;
two phrases of one name raise an error: counts carry 16 further bits of the first
part, which are compared.

A frequent phrase occurs in most tasks, and its parts need to be told once.  Each
row of a relation is of one of 256 classes, by a hash of its content; counting
finds the least class in which a phrase occurs, and only rows of that class tell
its parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Memo, Scratch, prepare

BLOCK_WORDS = 125_000     # words that a task gathers before it counts or writes them
RELATION_WORDS = 32_768   # words of one row of a relation
RELATION_ROWS = 8         # of its rows read together: a quarter of a megabyte each
ROW_GROUP = 16 << 20      # bytes of a relation that a writer holds
TASK_NAMES = 250_000      # different phrases that a task gathers before it hands on their counts
COUNT_WORDS = 500_000     # occurrences that a task adds up before it hands on their counts
RANGES_PER_SPLIT = 2      # counting tasks' key ranges for each split of the input, 64 at least
FILTER_BITS = 27          # the semi-join filter never has more bits than 2^27 (16 MB)
UNKNOWN = "und"

# What ends a piece, and what lies between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_SPACE = b" \t"

_GAP = b"\xff"  # occurs in no UTF-8 text
_TABLE = bytes(0xFF if b in PIECE_ENDS else 0x20 if b in WORD_SPACE else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX2
    return h ^ (h >> np.uint64(32))


_GAP_ID = np.uint64(xxhash.xxh3_64_intdigest(_GAP))


def words_of(text: str | None) -> list[bytes]:
    """Words in order, with a gap where a piece ends."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).replace(_GAP, b" " + _GAP + b" ").split()


def joined(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge-join of a relation with itself on adjacent places: ``(places, names)``
    of the phrases one word longer.  ``ids`` stands by place, 0 where nothing is."""
    at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
    names = _mixed(_mixed(ids[at]) + ids[at + 1])
    names[names == 0] = 1
    return at, names


class FrequentNames:
    """Semi-join filter: the names that may be frequent, all that are among them."""

    def __init__(self, words: np.ndarray, values: np.ndarray, bits: int):
        self.table, self.bits = np.zeros(1 << (bits - 6), np.uint64), bits
        self.table[words] = values.view(np.uint64)

    def has(self, names: np.ndarray) -> np.ndarray:
        at = names >> np.uint64(64 - self.bits)
        return (self.table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def semi_join_filter(frequent: DataFrame) -> FrequentNames:
    """Folds the column ``id`` into at most 2^``FILTER_BITS`` bits; past 64 bits a
    name it lets more names through, which the exact counts remove again."""
    n, bits = frequent.count(), 12
    while bits < FILTER_BITS and 1 << bits < 64 * n:
        bits += 1
    at = frequent.select(F.shiftrightunsigned("id", 64 - bits).alias("at"))
    folded = at.selectExpr("at >> 6 AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit")
    rows = folded.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    return FrequentNames(rows["word"].to_numpy(), rows["bits"].to_numpy(), bits)


CLASS_BITS, PART_BITS = 8, 16  # a mark is a row's class below some bits of the first part of a phrase


def _class_of(blob: bytes) -> np.uint32:
    """The class of a row of a relation."""
    return np.uint32(xxhash.xxh3_64_intdigest(blob) & ((1 << CLASS_BITS) - 1))


def _marks(first: np.ndarray, of: np.uint32) -> np.ndarray:
    return ((first & np.uint64((1 << PART_BITS) - 1)).astype(np.uint32) << np.uint32(CLASS_BITS)) | of


def _in_class(names: np.ndarray, of) -> np.ndarray:
    """Names of phrases told by a class."""
    return _mixed(names + np.asarray(of, np.uint64) * _MIX)


def _planes(a: np.ndarray) -> bytes:
    """Numbers by byte, the first bytes of all before the second ones, so that bytes that are alike compress."""
    return a.view(np.uint8).reshape(len(a), -1).T.tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _count_rows(names: np.ndarray, marks: np.ndarray, ranges: int) -> pd.DataFrame:
    """Names with their counts and least marks, cut by range: a frequent phrase is one
    entry of a block.  Names rise, so each is written as what it is above the one before."""
    order = np.argsort(names)
    names, marks = names[order], marks[order]
    part = marks >> np.uint32(CLASS_BITS)
    at = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (part[1:] != part[:-1])]))
    n, marks, names = np.diff(np.append(at, len(names))), np.minimum.reduceat(marks, at), names[at]
    r = (names >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(r)) + 1
    first = np.concatenate([[0], cuts])[:len(names)]
    return pd.DataFrame({"r": r[first].astype(np.int64), "names": [_planes(np.diff(x, prepend=np.uint64(0))) for x in np.split(names, cuts)][:len(first)],
                         "counts": [_planes(x.astype(np.uint32)) for x in np.split(n, cuts)][:len(first)],
                         "marks": [_planes(x) for x in np.split(marks, cuts)][:len(first)]})


class _Counts:
    """Occurrences of a task, added up before they are handed on."""

    def __init__(self, ranges: int):
        self.ranges, self.held, self.size = ranges, [], 0

    def add(self, names: np.ndarray, marks: np.ndarray) -> Iterator[pd.DataFrame]:
        self.held.append((names, marks))
        self.size += len(names)
        if self.size >= COUNT_WORDS:
            yield from self.flush()

    def flush(self) -> Iterator[pd.DataFrame]:
        if self.size:
            yield _count_rows(*(np.concatenate(c) for c in zip(*self.held)), self.ranges)
        self.held, self.size = [], 0


def _added_up(counted: DataFrame, least: int) -> DataFrame:
    """``id, n`` of the names that occur at least ``least`` times, and ``told``, the
    name of each in the class that tells its parts."""
    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        names = np.concatenate([np.cumsum(_numbers(b, np.uint64), dtype=np.uint64) for b in group["names"]])
        n, marks = (np.concatenate([_numbers(b, np.uint32) for b in group[c]]) for c in ("counts", "marks"))
        order = np.argsort(names)
        names, n, marks = names[order], n[order], marks[order]
        at = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        total = np.add.reduceat(n, at, dtype=np.int64)
        keep = total >= least
        lowest, highest = np.minimum.reduceat(marks, at)[keep], np.maximum.reduceat(marks, at)[keep]
        if (lowest >> np.uint32(CLASS_BITS) != highest >> np.uint32(CLASS_BITS)).any():
            raise ValueError("two phrases share a 64-bit name")
        names = names[at][keep]
        told = _in_class(names, lowest & np.uint32((1 << CLASS_BITS) - 1))
        return pd.DataFrame({"id": names.view(np.int64), "n": total[keep], "told": told.view(np.int64)})

    return counted.groupBy("r").applyInPandas(add_up, "id long, n long, told long")


class _Blocks:
    """Gathers the words of texts until a block is full."""

    def __init__(self):
        self.words: list[bytes] = []
        self.ids: list[np.ndarray] = []
        self.langs: list[str] = []
        self.size = 0

    def add(self, lang: str, text: str | None) -> None:
        words = words_of(text)
        if words:
            ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            self.words += words
            self.words.append(_GAP)
            named = np.maximum(_mixed(ids + np.uint64(_LANGS[lang])), np.uint64(1))
            self.ids += [np.where(ids == _GAP_ID, np.uint64(0), named), np.zeros(1, np.uint64)]
            self.langs.append(lang)
            self.size += len(words) + 1

    def block(self) -> np.ndarray:
        return np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint64)

    def lang_at(self, place: np.ndarray) -> list[str]:
        ends = np.cumsum([len(a) + len(b) for a, b in zip(self.ids[::2], self.ids[1::2])])
        return [self.langs[k] for k in np.searchsorted(ends, place, side="right")]


_LANGS = Memo(lambda lang: xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 7), 10_000)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[_Blocks]:
    held = _Blocks()
    for batch in batches:
        for lang, text in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
            held.add(lang, text)
            if held.size >= BLOCK_WORDS:
                yield held
                held = _Blocks()
    if held.size:
        yield held


def _word_counts(docs: DataFrame, ranges: int) -> DataFrame:
    """Counts of words by range, and a row per task and language with its words."""
    def emit(batches):
        counts, sizes = _Counts(ranges), {}
        for held in _gathered(batches):
            ids = held.block()
            ids = ids[ids != 0]
            for out in counts.add(ids, np.zeros(len(ids), np.uint32)):
                yield out.assign(lang=None, n=0)
            for lang, a in zip(held.langs, held.ids[::2]):
                sizes[lang] = sizes.get(lang, 0) + int(np.count_nonzero(a))
        for out in counts.flush():
            yield out.assign(lang=None, n=0)
        if sizes:
            yield pd.DataFrame({"r": -1, "names": None, "counts": None, "marks": None, "lang": list(sizes), "n": list(sizes.values())})

    return docs.mapInPandas(emit, "r long, names binary, counts binary, marks binary, lang string, n long")


_KINDS = "kind string, ids binary, id long, left long, right long, lang string, word string, n long"


def _relation_rows(ids: np.ndarray) -> pd.DataFrame:
    """Rows of about ``RELATION_WORDS`` places, cut where nothing stands, so that no phrase is cut."""
    gaps = np.flatnonzero(ids == 0)
    after = np.searchsorted(gaps, np.arange(RELATION_WORDS, len(ids), RELATION_WORDS))
    parts = [p for p in np.split(ids, np.unique(gaps[after[after < len(gaps)]])) if p.any()]
    return pd.DataFrame({"kind": "relation", "ids": [p.tobytes() for p in parts], **dict.fromkeys(("id", "left", "right", "lang", "word", "n"))}).astype(
        {c: "Int64" for c in ("id", "left", "right", "n")})


class _Names:
    """Phrases of a task with their counts, handed on when there are many."""

    def __init__(self, *parts: str):
        self.parts, self.held, self.size = parts, [], 0

    def add(self, id: np.ndarray, n: np.ndarray, *parts) -> Iterator[pd.DataFrame]:
        self.held.append((id, n, *[np.asarray(p) for p in parts]))
        self.size += len(id)
        if self.size > 2 * TASK_NAMES:
            self._fold()
            if self.size > TASK_NAMES:
                yield from self.flush()

    def _fold(self) -> None:
        id, n, *parts = (np.concatenate(c) for c in zip(*self.held))
        id, first, of = np.unique(id, return_index=True, return_inverse=True)
        for p in parts:
            if (p != p[first][of.reshape(-1)]).any():
                raise ValueError("two phrases share a 64-bit name")
        self.held = [(id, np.bincount(of.reshape(-1), n, len(id)).astype(np.int64), *[p[first] for p in parts])]
        self.size = len(id)

    def flush(self) -> Iterator[pd.DataFrame]:
        if self.held:
            self._fold()
            id, n, *parts = self.held[0]
            named = {"id": id.view(np.int64), "n": n, **{c: p.view(np.int64) if p.dtype == np.uint64 else p for c, p in zip(self.parts, parts)}}
            out = pd.DataFrame({"kind": "name", "ids": None, **dict.fromkeys(("id", "left", "right", "lang", "word", "n")), **named}, index=range(len(id)))
            yield out.astype({c: "Int64" for c in ("id", "left", "right", "n")})
            self.held, self.size = [], 0


def _first_relation(docs: DataFrame, known) -> DataFrame:
    """R_1 in blocks (kind ``relation``), and its words with their counts (kind ``name``)."""
    def emit(batches):
        named = _Names("lang", "word")
        for held in _gathered(batches):
            ids = held.block()
            ids[~known.value.has(ids)] = 0
            yield _relation_rows(ids)
            at = np.flatnonzero(ids)
            names, first, n = np.unique(ids[at], return_index=True, return_counts=True)
            words = [held.words[k].decode("utf-8", "surrogatepass") for k in at[first]]
            yield from named.add(names, n, np.array(held.lang_at(at[first]), object), np.array(words, object))
        yield from named.flush()

    return docs.mapInPandas(emit, _KINDS)


def _next_counts(relation: DataFrame, ranges: int) -> DataFrame:
    def emit(batches):
        counts = _Counts(ranges)
        for batch in batches:
            for blob in batch["ids"]:
                ids = np.frombuffer(blob, np.uint64)
                at, names = joined(ids)
                yield from counts.add(names, _marks(ids[at], _class_of(blob)))
        yield from counts.flush()

    return relation.select("ids").mapInPandas(emit, "r long, names binary, counts binary, marks binary")


def _next_relation(relation: DataFrame, known, told) -> DataFrame:
    """R_(k+1) of the frequent names, and its phrases by their parts (kind ``name``),
    told by the rows of their class."""
    def emit(batches):
        named = _Names("left", "right")
        for batch in batches:
            for blob in batch["ids"]:
                ids = np.frombuffer(blob, np.uint64)
                at, names = joined(ids)
                keep = known.value.has(names)
                at, names = at[keep], names[keep]
                if not len(at):
                    continue
                longer = np.zeros(len(ids), np.uint64)
                longer[at] = names
                yield _relation_rows(longer)
                tell = told.value.has(_in_class(names, _class_of(blob)))
                at, names = at[tell], names[tell]
                if not len(at):
                    continue
                names, first, of, n = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
                left, right = ids[at], ids[at + 1]
                if ((left != left[first][of.reshape(-1)]) | (right != right[first][of.reshape(-1)])).any():
                    raise ValueError("two phrases share a 64-bit name")
                yield from named.add(names, n, left[first], right[first])
        yield from named.flush()

    return relation.select("ids").mapInPandas(emit, _KINDS)


def _sole(named: DataFrame, *parts: str) -> DataFrame:
    """One row per name; a name of two phrases is an error."""
    same = named.groupBy("id").agg(F.sum("n").alias("f"), *[F.min(p).alias(p) for p in parts],
                                   F.max(F.struct(*parts)).alias("__hi"), F.min(F.struct(*parts)).alias("__lo"))
    clash = F.raise_error(F.lit("two phrases share a 64-bit name"))
    return same.withColumn("f", F.when(F.col("__hi") == F.col("__lo"), F.col("f")).otherwise(clash)).drop("__hi", "__lo")


def _with_parts(frequent: DataFrame, named: DataFrame) -> DataFrame:
    """``id, f, left, right`` of the frequent phrases; one whose parts nothing told is an error."""
    parts = _sole(named, "left", "right").select("id", "left", "right")
    untold = F.raise_error(F.lit("a frequent phrase without its parts")).cast("long")
    return frequent.select("id", F.col("n").alias("f")).join(parts, "id", "left").withColumn("left", F.coalesce("left", untold))


def mine_phrases(docs: DataFrame, least: int = 30, longest: int = 4, text: str = "text", lang: str = "lang",
                 absorbed_percent: int = 80) -> DataFrame:
    """Phrases of 2 to ``longest`` words that occur ``least`` times or more in a
    language, scored by their weakest cut: ``lang, phrase, words, a, l, r, n, score``.

    A-Z are lower-cased, pieces end at punctuation and line ends, words at
    spaces and tabs; all occurrences within pieces count, overlaps included.
    ``score`` is floor(2000000 a / (l + r)) of the lowest-scoring cut, the first
    of equal ones; ``n`` the words of the language.  A phrase that lies in a
    longer frequent one with ``absorbed_percent`` or more of its occurrences is
    left out.  Nothing else is: every text is read whole.

    Null texts are empty, empty ones give nothing, a null language is ``und``,
    repeated rows count again, an empty table gives an empty table; other
    columns are not read.  A text longer than a block is a block of its own.
    Occurrences stay with their split of the input, however frequent a phrase or
    language is; counts are added up in each block before they are shuffled.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "phrases")
    docs = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    ranges = max(64, RANGES_PER_SPLIT * docs.rdd.getNumPartitions())

    counted = scratch.keep(_word_counts(docs, ranges))
    sizes = scratch.keep(counted.filter("r < 0").groupBy("lang").agg(F.sum("n").alias("n")))
    frequent = scratch.keep(_added_up(counted.filter("r >= 0").select("r", "names", "counts", "marks"), least))
    scratch.drop(counted)
    known = spark.sparkContext.broadcast(semi_join_filter(frequent))
    step = scratch.keep(_first_relation(docs, known), by="kind", row_group=ROW_GROUP)
    words = _sole(step.filter("kind = 'name'"), "lang", "word").filter(F.col("f") >= least)
    none = F.array().cast("array<bigint>")
    levels = [scratch.keep(words.select("id", "lang", F.col("word").alias("phrase"), "f", none.alias("ls"), none.alias("rs")))]
    prepare(spark, RELATION_ROWS)
    for _ in range(2, longest + 1):
        relation = step.filter("kind = 'relation'")
        frequent = scratch.keep(_added_up(_next_counts(relation, ranges), least))
        known = spark.sparkContext.broadcast(semi_join_filter(frequent))
        told = spark.sparkContext.broadcast(semi_join_filter(frequent.select(F.col("told").alias("id"))))
        longer = scratch.keep(_next_relation(relation, known, told), by="kind", row_group=ROW_GROUP)
        scratch.drop(step)
        step = longer
        levels.append(scratch.keep(_phrases(_with_parts(frequent, step.filter("kind = 'name'")), levels[-1])))
    scratch.drop(step)
    prepare(spark)
    found = None
    for k in range(1, len(levels)):
        level = levels[k]
        if k + 1 < len(levels):
            # A phrase in one two words longer also lies, as often at least, in one a word longer.
            longer = levels[k + 1].select(F.explode(F.array("left", "right")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("above"))
            level = (level.join(longer, "id", "left")
                     .filter(F.col("above").isNull() | (_wide("above") * 100 < _wide("f") * absorbed_percent)).drop("above"))
        level = level.withColumn("words", F.lit(k + 1))
        found = level if found is None else found.unionAll(level)
    best = F.expr("array_min(transform(arrays_zip(ls, rs, sequence(1, size(ls))), "
                  "c -> struct(CAST(f AS DECIMAL(20,0)) * 2000000 div (CAST(c.ls AS DECIMAL(20,0)) + c.rs) AS score, c.`2` AS k, c.ls AS l, c.rs AS r)))")
    return (found.withColumn("best", best).join(sizes, "lang")
            .select("lang", "phrase", "words", F.col("f").alias("a"), "best.l", "best.r", "n", F.col("best.score").cast("long").alias("score")))


def _wide(name: str):
    return F.col(name).cast("decimal(20,0)")


def _phrases(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Words and cuts of phrases, from those of their two parts: ``ls`` has the
    occurrences of the first 1, 2, ... words, ``rs`` of the words behind them."""
    a, b = (shorter.select(F.col("id").alias(side), F.struct("lang", "phrase", "f", "ls", "rs").alias(side[0])) for side in ("left", "right"))
    last_word = F.substring_index("r.phrase", " ", -1)
    return found.join(a, "left").join(b, "right").select(
        "id", F.col("l.lang").alias("lang"), F.concat_ws(" ", "l.phrase", last_word).alias("phrase"), "f",
        F.concat("l.ls", F.array("l.f")).alias("ls"), F.concat(F.array("r.f"), "r.rs").alias("rs"), "left", "right")


SALTS = 32  # parts of a language that are ranked apart first


def best_of_each_language(phrases: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of each language, with ``rank`` from 1: by score,
    then count, both falling, then phrase in byte order.

    Parts of a language, by a hash, keep their own first ones; only ``SALTS`` times
    ``most`` phrases of a language meet in one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = phrases.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("rank") <= most).drop("__salt", "rank")
    return parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)
