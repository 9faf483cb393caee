"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

A piece starts as its bytes.  A heap holds the adjacent pairs that have a merge,
by rank and position; a doubly linked list holds the symbols.  The lowest pair
is popped again and again, stale entries are skipped, and two symbols become
one.  The count is the number of initial symbols less the number of merges.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Memo, chunks, prepare

# Fixed value: the split pattern of the byte-level pre-tokenizer.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the others for the next
    free code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class MergeCounter:
    """Counts the tokens of texts by the merges of a byte-level BPE file."""

    def __init__(self, file: bytes, memo: int = 400_000):
        spec = json.loads(file)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
                or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE files without a normalizer are counted")
        letters = byte_letters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Symbols are numbers: a byte itself, or 256 + the first merge that makes it.
        number = dict(letters)
        for k, (a, b) in enumerate(pairs):
            number.setdefault(a + b, 256 + k)
        self.rank: dict[int, int] = {}
        self.made = [number[a + b] for a, b in pairs]
        for k, (a, b) in enumerate(pairs):
            self.rank.setdefault(number[a] << 32 | number[b], k)
        added = sorted((t["content"] for t in spec.get("added_tokens") or []), key=len, reverse=True)
        if any(" " in t for t in added):
            raise ValueError("texts are cut before spaces, so an added token may not hold one")
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.find = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.pieces = Memo(lambda p: self.count_piece(p.encode("utf-8", "surrogatepass")), memo)
        self.chunks = Memo(self._chunk, memo)

    def count_piece(self, piece: bytes) -> int:
        n = len(piece)
        if n < 2:
            return n
        rank, made = self.rank, self.made
        symbol = list(piece)
        heap = [(r, i, symbol[i], symbol[i + 1]) for i in range(n - 1)
                if (r := rank.get(symbol[i] << 32 | symbol[i + 1])) is not None]
        if not heap:
            return n
        heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = 0
        while heap:
            r, i, left, right = heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # one of the two has been merged since
            new = symbol[i] = made[r]
            symbol[j] = -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(new << 32 | symbol[k])) is not None:
                    heappush(heap, (r, i, new, symbol[k]))
            h = before[i]
            if h >= 0 and (r := rank.get(symbol[h] << 32 | new)) is not None:
                heappush(heap, (r, h, symbol[h], new))
        return n - merges

    def _chunk(self, chunk: str) -> int:
        if self.added is None:
            return self._plain(chunk)
        found, rest = 0, []
        at = 0
        for m in self.added.finditer(chunk):
            found += 1
            rest.append(chunk[at:m.start()])
            at = m.end()
        rest.append(chunk[at:])
        return found + sum(map(self._plain, rest))

    def _plain(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, self.find(text)))

    def count(self, text: str | None) -> int:
        return sum(map(self.chunks.__getitem__, chunks(text or "")))


_COUNTERS: dict[str, MergeCounter] = {}


def counter_for(key: str, file: bytes) -> MergeCounter:
    """One counter per Python worker and vocabulary."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = MergeCounter(file)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Bytes and tokens of every whole text: ``id, n_bytes, n_tokens, over_limit``.

    Counts are those of the tokenizer file at ``path``; an added token found in
    a text counts as one.  A null or empty text has 0 bytes and 0 tokens.  One
    row per input row, nothing is shuffled.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(path, "rb") as f:
        file = f.read()
    shipped, key = spark.sparkContext.broadcast(file), hashlib.sha256(file).hexdigest()

    def counted(batches):
        counter = counter_for(key, shipped.value)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.iloc[:, 1]]
            yield pd.DataFrame({
                id: batch.iloc[:, 0].values,
                "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                "n_tokens": [counter.count(t) for t in texts],
            }).astype({"n_bytes": "int64", "n_tokens": "int64"})

    plain = docs.select(F.col(id), F.col(text).alias("__text"))
    kind = plain.schema[id].dataType.simpleString()
    out = plain.mapInPandas(counted, f"`{id}` {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
