"""Vector bin packing of token sequences.

Every item is a vector: tokens, one segment, loss-bearing tokens.  A sequence
has a limit in each.  A sequence is filled by taking, of the items that still
fit, the one whose vector has the largest dot product with what is left of the
limits, until none fits.  Documents longer than a sequence are cut: whole
sequences first, and the rest is an item.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import zlib

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, prepare
from .token_counts import BYTE_LEVEL_PATTERN, byte_letters

# Items that one task packs together; groups are cut by a hash of the row.
GROUP_ITEMS = 16384


def place(tokens: np.ndarray, loss: np.ndarray, max_tokens: int, max_segments: int, max_loss: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item (within one group).

    Items alike in both sizes are one kind, so that a step costs the number of
    kinds, at most tokens times loss values that occur, not of items.  Ties go
    to the kind with more tokens, then more loss; within a kind, to the first.
    """
    kinds, kind_of = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    order = np.argsort(kind_of, kind="stable")
    starts = np.searchsorted(kind_of[order], np.arange(len(kinds) + 1))
    taken, end = starts[:-1].copy(), starts[1:]
    size = np.concatenate([kinds, np.ones((len(kinds), 1), int)], 1)  # tokens, loss, segments
    limit = np.array([max_tokens, max_loss, max_segments])
    if len(size) and (size > limit).any():
        raise ValueError("an item is larger than a sequence")
    scaled = size / limit
    sequence, offset = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
    left_items, number = len(tokens), -1
    alive = np.arange(len(kinds))
    while left_items:
        number += 1
        left, at = limit.copy(), 0
        fits = alive
        while len(fits):
            fits = fits[(size[fits] <= left).all(1)]
            if not len(fits):
                break
            worth = scaled[fits] @ (left / limit)
            k = fits[len(worth) - 1 - int(np.argmax(worth[::-1]))]
            item = order[taken[k]]
            sequence[item], offset[item] = number, at
            at += int(tokens[item])
            left = left - size[k]
            taken[k] += 1
            left_items -= 1
            if taken[k] == end[k]:
                alive = alive[alive != k]
                fits = fits[fits != k]
    return sequence, offset


def pack_items(items: DataFrame, max_tokens: int, max_segments: int, max_loss: int) -> DataFrame:
    """Places written items (``tokens``, ``loss_tokens``, unique long ``tie``) into
    sequences: adds ``sequence_id`` (odd, unique) and ``offset``.

    Groups of about ``GROUP_ITEMS`` rows, cut by a hash of ``tie``, are packed
    each in one task; no key of the data decides, so none can be hot.  An empty
    table gives an empty table.  An item over a limit raises an error.
    """
    groups = max(1, -(-items.count() // GROUP_ITEMS))
    fields = items.schema

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("tie", kind="stable")
        sequence, offset = place(group["tokens"].to_numpy(), group["loss_tokens"].to_numpy(), max_tokens, max_segments, max_loss)
        out = group[[f.name for f in fields]].copy()
        out["sequence_id"] = (int(group["__group"].iloc[0]) << 34) + 2 * sequence + 1
        out["offset"] = offset
        return out

    spread = items.withColumn("__group", F.pmod(F.xxhash64("tie"), F.lit(groups)))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return spread.groupBy("__group").applyInPandas(pack, f"{types}, sequence_id long, offset long")


class IdBytes:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The ids are those of the byte-level BPE file.  Where its merges stand in the
    order of their ids, ids serve as ranks and the faster rank encoder gives the
    same result (tested); any other file, and a text that the rank encoder's
    pattern cannot take (very long runs of white space), goes through the file's
    own library.
    """

    def __init__(self, file: bytes):
        self.file, self.rank_encoder = file, None
        spec = json.loads(file)
        vocab, merges = spec["model"]["vocab"], spec["model"].get("merges") or []
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        made = [vocab[a + b] for a, b in pairs]
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer") and made == sorted(made):
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in added}
            self.rank_encoder = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=added)

    @functools.cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        out = Tokenizer.from_str(self.file.decode())
        out.no_truncation()
        out.no_padding()
        return out

    def of(self, text: str) -> bytes:
        ids = None
        if self.rank_encoder is not None:
            try:
                ids = self.rank_encoder.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
        if ids is None:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return ids.astype("<u4").tobytes()


_ENCODERS: dict[str, IdBytes] = {}


def _encoder(key: str, file: bytes) -> IdBytes:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = IdBytes(file)
    return _ENCODERS[key]


def cut_documents(docs: DataFrame, path: str, max_tokens: int, max_loss: int | None = None, end_id: int = 0, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Pieces of at most ``max_tokens`` ids and ``max_loss`` loss-bearing ones: ``id,
    start, tokens, loss_tokens, ids_crc32, doc_tokens, sequence_id, tie``.

    A document's ids are those of the tokenizer file at ``path``, then
    ``end_id``; a null text counts as empty, so each row gives a piece.  A
    document's first id is predicted from nothing and bears no loss.  A piece as
    long as the limits let it be has its own (even) ``sequence_id``; the others
    have null.
    """
    max_loss = max_loss or max_tokens
    spark = docs.sparkSession
    prepare(spark)
    with open(path, "rb") as f:
        file = f.read()
    shipped, key = spark.sparkContext.broadcast(file), hashlib.sha256(file).hexdigest()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        encoder, part = _encoder(key, shipped.value), TaskContext.get().partitionId()
        row = whole = 0
        for batch in batches:
            rows = []
            for doc, t in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                ids = encoder.of(t or "") + end
                n, start = len(ids) // 4, 0
                while start < n:
                    most = min(max_tokens, max_loss + (start == 0))
                    length = min(most, n - start)
                    sequence = None
                    if length == most:
                        sequence = (part << 34) + 2 * whole
                        whole += 1
                    rows.append((doc, start, length, length - (start == 0), zlib.crc32(ids[4 * start:4 * (start + length)]),
                                 n, sequence, (part << 34) + row))
                    row += 1
                    start += length
            out = pd.DataFrame(rows, columns=names)
            out["sequence_id"] = out["sequence_id"].astype("Int64")
            out[id] = pd.array(out[id], dtype="Int64") if kind in ("bigint", "int") else out[id].astype(object)
            yield out

    names = [id, "start", "tokens", "loss_tokens", "ids_crc32", "doc_tokens", "sequence_id", "tie"]
    plain = docs.select(F.col(id), F.col(text).alias("__text"))
    kind = plain.schema[id].dataType.simpleString()
    return plain.mapInPandas(cut, f"`{id}` {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


def pack_documents(docs: DataFrame, path: str, max_tokens: int = 1024, max_segments: int = 64, max_loss: int | None = None,
                   end_id: int = 0, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Packs all documents into sequences: one row per piece with ``id, start,
    length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset``.

    Pieces as long as the limits let them be stand alone in a sequence; the rest of
    each document is packed under the three limits, of which ``max_loss`` (default:
    no limit of its own) bounds the loss-bearing tokens of a sequence.  The pieces are written once, so the packing
    reads small rows only and a lost executor costs no second encoding.  Null
    and empty texts give a piece of the end id; repeated rows are packed like
    any others; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    pieces = Scratch(spark, "packing").keep(cut_documents(docs, path, max_tokens, max_loss, end_id, text, id))
    rest = pack_items(pieces.filter("sequence_id IS NULL").drop("sequence_id"), max_tokens, max_segments, max_loss or max_tokens)
    whole = pieces.filter("sequence_id IS NOT NULL").withColumn("offset", F.lit(0).cast("long"))
    columns = [F.col(id), "start", F.col("tokens").alias("length"), "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
    return whole.select(*columns).unionAll(rest.select(*columns))
