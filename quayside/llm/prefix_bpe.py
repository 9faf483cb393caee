"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of its
encoding.  ``PrefixTable`` stores that token per prefix.  The token ending at
position i is the one whose left neighbour, the stored last token of the prefix
before it, stays apart from it when the two are merged alone.  Appending bytes
only adds table entries; an edit drops the entries behind it, and the encoding
is read off backwards.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Memo, chunks, prepare


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: one base64 token and its rank per line."""
    out = {}
    for line in lines.splitlines():
        if line.strip():
            token, rank = line.split()
            out[base64.b64decode(token)] = int(rank)
    return out


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 62) -> list[int]:
    """Plain BPE: always merge the adjacent pair of lowest rank, leftmost first,
    while it ranks under ``below``.

    Only for single tokens and as the yardstick of the tests.
    """
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1)
                    if parts[i] + parts[i + 1] in ranks), default=None)
        if best is None or best[0] >= below:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class _Steps(dict):
    """Moves between states, computed when first met; at most ``MOST`` are held."""

    MOST = 500_000

    def __init__(self, fn):
        super().__init__()
        self.fn = fn

    def __missing__(self, move: int) -> int:
        if len(self) >= self.MOST:
            self.clear()
        state = self[move] = self.fn(move)
        return state


class Vocabulary:
    """Ranks with what the prefix table asks of them."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # Tokens that their own bytes merge into; others close nothing.
        closing = {t: r for t, r in ranks.items() if merge_by_rank(t, ranks) == [r]}

        def longest_ending(stretch: bytes, at: int = 0) -> int:
            return next((closing[stretch[k:]] for k in range(at, len(stretch)) if stretch[k:] in closing), -1)

        # A state is the longest end of the bytes so far with which a token can
        # begin; it knows the longest token that ends there, and every token the
        # next shorter one (-1: none).
        self.states = {b"": 0}
        for t in ranks:
            for k in range(1, len(t) + 1):
                self.states.setdefault(t[:k], len(self.states))
        self._stretches = list(self.states)
        self.closes = [longest_ending(stretch) for stretch in self._stretches]
        self.shorter = {r: longest_ending(t, 1) for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.step = _Steps(self._step)
        self._apart: dict[int, bool] = {}
        self._edges: dict[tuple[int, bool], list[int]] = {}

    def _step(self, move: int) -> int:
        """The state after ``move``: a state and the byte that follows, in the last 8 bits."""
        stretch = self._stretches[move >> 8] + bytes([move & 255])
        return next(self.states[stretch[k:]] for k in range(len(stretch) + 1) if stretch[k:] in self.states)

    def edge(self, token: int, right: bool) -> list[int]:
        """The tokens that stand at the right (left) end while ``token`` is
        merged from its bytes, from the single byte to the token itself."""
        known = self._edges.get((token, right))
        if known is None:
            data, out = self.tokens[token], [token]
            if len(data) > 1:
                ends = merge_by_rank(data, self.ranks, below=token)  # the two parts of the last merge
                out = self.edge(ends[-1 if right else 0], right) + out
            self._edges[token, right] = known = out
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether the bytes of two whole tokens merge into just these two.

        Both grow from single bytes in the order of the ranks; they join if at
        some time the pair at the seam ranks below the next merge on either side
        (of equal ranks the leftmost goes first).
        """
        seam = left << 32 | right
        known = self._apart.get(seam)
        if known is None:
            if len(self._apart) > 300_000:
                self._apart.clear()
            known = self._apart[seam] = self._stays_apart(self.edge(left, True), self.edge(right, False))
        return known

    def _stays_apart(self, grows_left: list[int], grows_right: list[int]) -> bool:
        never, i, j = 1 << 62, 0, 0
        while True:
            a, b = grows_left[i], grows_right[j]
            next_a = grows_left[i + 1] if i + 1 < len(grows_left) else never
            next_b = grows_right[j + 1] if j + 1 < len(grows_right) else never
            seam = self.ranks.get(self.tokens[a] + self.tokens[b], never)
            if seam < next_a and seam <= next_b and seam != never:
                return False
            if next_a == next_b == never:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class PrefixTable:
    """The unique last token of every prefix of a growing byte string.

    ``append`` and ``replace`` keep the table exact: ``tokens()`` always equals
    the BPE of the bytes held now, taken as one piece.
    """

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []
        self._state: list[int] = []  # of every prefix, to go on after an edit
        self.append(data)

    def append(self, more: bytes) -> "PrefixTable":
        end, last, states, v = len(self.data), self.last, self._state, self.vocabulary
        self.data += more
        step, closes, shorter, size, known, apart = v.step, v.closes, v.shorter, v.size, v._apart, v.apart
        state = states[-1] if states else 0
        for byte in more:
            end += 1
            state = step[state << 8 | byte]
            token = closes[state]
            while token >= 0:  # long tokens are the likelier ones
                begin = end - size[token]
                if not begin:
                    break
                before = last[begin - 1]
                fits = known.get(before << 32 | token)
                if apart(before, token) if fits is None else fits:
                    break
                token = shorter[token]
            else:
                raise ValueError("no token of the vocabulary closes this prefix")
            last.append(token)
            states.append(state)
        return self

    def replace(self, start: int, stop: int, new: bytes) -> "PrefixTable":
        """Replaces ``data[start:stop]``; prefixes up to ``start`` are kept, and
        behind the edit only bytes up to the end are computed again."""
        tail = bytes(self.data[stop:])
        del self.data[start:], self.last[start:], self._state[start:]
        return self.append(new + tail)

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= self.vocabulary.size[token]
        return out[::-1]


class Codec:
    """Encodes and decodes texts: every match of ``pattern`` is one piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 350_000):
        self.vocabulary = Vocabulary(ranks)
        self.find = regex.compile(pattern).findall
        self.pieces = Memo(self._piece, memo)
        self.chunks = Memo(self._chunk, memo)
        self.listed = Memo(self._listed, memo)

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        token = self.vocabulary.ranks.get(data)  # a piece that is a token stays whole
        if token is not None:
            return (token,)
        return tuple(PrefixTable(self.vocabulary, data).tokens())

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.find(chunk))))

    def _listed(self, chunk: str) -> tuple[int, str, bytes]:
        ids = self._chunk(chunk)
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and the SHA-256 of the ids (decimal, joined by commas)
        and of the bytes they decode to."""
        found = [x for x in map(self.listed.__getitem__, chunks(text or "")) if x[0]]
        ids, data = ",".join([x[1] for x in found]), b"".join([x[2] for x in found])
        return sum([x[0] for x in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(data).hexdigest()

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.chunks.__getitem__, chunks(text or ""))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


_CODECS: dict[tuple, Codec] = {}


def codec_for(key: str, file: bytes, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary."""
    if (key, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[key, pattern] = Codec(read_ranks(file), pattern)
    return _CODECS[key, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Token ids of every whole text, and the bytes they decode to.

    Returns ``id, token_ids array<int>, decoded binary``, one row per input row.
    A null or empty text has no ids and decodes to no bytes.  The ranks file
    (``path``, bounded by the vocabulary) is read on the driver and shipped to
    the workers.  Nothing is shuffled; a hot source or repeated rows only share
    memoised chunks.
    """
    def both(codec, t):
        ids = codec.encode(t)
        return ids, codec.decode(ids)

    return _encoded(docs, path, pattern, text, id, "token_ids array<int>, decoded binary", both)


def encode_digests(docs: DataFrame, path: str, pattern: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """As :func:`encode_documents`, but digests in place of ids and bytes, so
    that they need not travel: ``id, n_tokens long, ids_sha256 (of the decimal
    ids joined by commas), decoded_sha256``."""
    return _encoded(docs, path, pattern, text, id,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string", Codec.digests)


def _encoded(docs, path, pattern, text, id, fields, shape):
    spark = docs.sparkSession
    prepare(spark)
    with open(path, "rb") as f:
        file = f.read()
    shipped, key = spark.sparkContext.broadcast(file), hashlib.sha256(file).hexdigest()

    def encode(batches):
        codec = codec_for(key, shipped.value, pattern)
        for batch in batches:
            rows = [shape(codec, t) for t in batch.iloc[:, 1]]
            out = pd.DataFrame(rows, columns=names, dtype=object)
            out.insert(0, id, batch.iloc[:, 0].values)
            yield out

    names = [f.split()[0] for f in fields.split(", ")]
    plain = docs.select(F.col(id), F.col(text).alias("__text"))
    kind = plain.schema[id].dataType.simpleString()
    return plain.mapInPandas(encode, f"`{id}` {kind}, {fields}")
