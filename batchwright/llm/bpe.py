"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

Each match of the pre-token pattern is encoded on its own.  Its bytes form a
doubly linked list; every neighbouring pair that is a token stands in the bucket
of that token's rank, by list position.  A three-level bitmap over the ranks
gives the least rank with find-first-set; the positions of its bucket are merged
from left to right, and those whose pair has changed since are stale and skipped.
Should a merge make a pair of a lesser rank, that rank is served first and the
rest of the bucket waits.  Each merge costs a constant number of queue steps, so
a pre-token of any length takes about linear time.  Many pre-tokens share one
queue: their lists lie behind each other with a gap between them that no pair
spans, so finding a rank is paid once for all of them.  The lists are arrays: a
bucket of many positions is merged in one go, unless two of its pairs overlap or a
merge makes a pair of a lesser rank; then, as in small buckets, one after another.

Ranks are read where their file lies on each executor.  Frequent chunks are kept
encoded in a bounded cache per Python worker.

Defined results: null and empty texts have no ids and decode to no bytes; an
empty table gives no rows; repeated rows are encoded alike; columns other than id
and text are not read.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.functions import pandas_udf

from .common import ChunkEncoder, doc_columns, row_type

_ENCODERS: dict[str, "ByteBpe"] = {}

#: Positions from which a bucket is merged in one go, and characters of the texts that share a queue.
WIDE, BLOCK = 40, 4_000_000


class RankQueue:
    """Buckets of positions by rank, under a three-level bitmap of 64-bit words."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, list[int]]:
        """Least rank and its positions in order; the queue must not be empty (``top``)."""
        block = (self.top & -self.top).bit_length() - 1
        bits = self.mid[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        self.low[word] &= bits - 1
        if not self.low[word]:
            self.mid[block] &= self.mid[block] - 1
            if not self.mid[block]:
                self.top &= self.top - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class AgingEncoder(ChunkEncoder):
    """A :class:`ChunkEncoder` whose caches have two generations.

    A younger generation at its limit becomes the older one, and what that one held is
    forgotten; what is found in the older one moves to the younger, so entries in use stay."""

    def __init__(self, *args, **limits):
        super().__init__(*args, **limits)
        self.old_pieces: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}

    def _encode_new(self, new: list[str]) -> None:
        known = self.old_pieces.keys() & new
        self.pieces.update((p, self.old_pieces[p]) for p in known)
        super()._encode_new([p for p in new if p not in known])

    def _learn(self, chunks: set[str], firsts: list[str]) -> list[bytes]:
        known = self.old_chunks.keys() & chunks
        self.chunks.update((w, self.old_chunks[w]) for w in known)
        return super()._learn(chunks - known, firsts)

    def _trim(self) -> None:
        if len(self.chunks) >= self.limit:
            self.chunks, self.old_chunks = {}, self.chunks
        if len(self.pieces) >= self.piece_limit:
            self.pieces, self.old_pieces = {}, self.pieces


class ByteBpe:
    """Encoder and decoder for one file of ranks (base64 token, rank a line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.whole = {t: i.to_bytes(4, "little") for t, i in self.ranks.items()}  # ids of a pre-token that is a token
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, i in self.ranks.items():
            self.tokens[i] = t
        self.queue = RankQueue(max(self.ranks.values()))  # empty between calls
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.double = np.full(1 << 16, -1, np.int64)  # rank of two bytes
        for t, i in self.ranks.items():
            if len(t) == 2:
                self.double[t[0] << 8 | t[1]] = i
        self.encode_texts = AgingEncoder(pattern, self._pieces, limit=500_000, piece_limit=100_000, block=BLOCK)
        splits = [  # every way in which two tokens make a token: left id, right id, rank
            (a << 32 | b, i) for t, i in self.ranks.items() for c in range(1, len(t)) if (a := self.ranks.get(t[:c])) is not None and (b := self.ranks.get(t[c:])) is not None
        ]
        splits.sort()
        self.split_keys, self.split_ranks = (np.array(x, np.int64) for x in zip(*[*splits, (1 << 62, -1)]))
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two symbols make; -1 for none."""
        keys = left << 32 | right
        at = np.searchsorted(self.split_keys, keys)
        return np.where(self.split_keys[at] == keys, self.split_ranks[at], -1)

    def _merge_wide(self, rank: int, bucket: list[int], ids: np.ndarray, end: np.ndarray, before: np.ndarray, pair: np.ndarray) -> bool:
        """Merge a whole bucket; False, and nothing done, where order matters."""
        i = np.array(bucket, np.int64)
        i = i[np.append(True, i[1:] != i[:-1])]
        i = i[pair[i] == rank]  # the others are stale
        if not len(i):
            return True
        j = end[i]
        k = end[j]
        if (j[:-1] == i[1:]).any():
            return False  # two pairs share a symbol
        nextto = np.append(k[:-1] == i[1:], False)  # the symbol behind is merged too
        stop, id_behind = end[k], ids[k]
        live = stop != 0
        behind = np.full(len(i), -1, np.int64)
        behind[live] = self._joined(np.full(int(live.sum()), rank), np.where(nextto, rank, id_behind)[live])
        early = self._joined(np.full(int(nextto.sum()), rank), id_behind[nextto])  # pairs that would stand until then
        h = before[i]
        h[1:][nextto[:-1]] = i[:-1][nextto[:-1]]
        left = (end[h] != 0) & ~np.append(False, nextto[:-1])  # those are the pair behind the one before
        h = h[left]
        ahead = self._joined(ids[h], np.full(len(h), rank))
        made = np.concatenate([behind, ahead])
        if ((made >= 0) & (made < rank)).any() or ((early >= 0) & (early < rank)).any():
            return False
        end[i], end[j], before[k], ids[i], pair[j] = k, 0, i, rank, -1
        pair[h] = ahead
        pair[i] = behind
        places = np.concatenate([i, h])
        found = made >= 0
        self._open_all(made[found], places[found])
        return True

    def _open_all(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Puts places into the buckets of their ranks."""
        order = np.argsort(ranks, kind="stable")
        values, begin = np.unique(ranks[order], return_index=True)
        places, bucket_of, opened = places[order].tolist(), self.queue.buckets.get, self.queue.open
        for r, a, b in zip(values.tolist(), begin.tolist(), [*begin.tolist()[1:], len(places)]):
            if (held := bucket_of(r)) is not None:
                held += places[a:b]
            else:
                opened(r, places[a:b])

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, little-endian unsigned 32-bit."""
        data = b"\0".join(pieces) + b"\0"
        n, raw = len(data), np.frombuffer(data, np.uint8).astype(np.int64)
        gaps = np.cumsum([len(p) + 1 for p in pieces]) - 1
        ends = np.arange(1, n + 1)
        ends[gaps] = 0
        first = np.append(self.double[raw[:-1] << 8 | raw[1:]], -1)
        first[gaps] = first[gaps - 1] = -1
        symbols = self.single[raw]
        befores = np.arange(-1, n - 1)
        queue, get = self.queue, self.ranks.get
        bucket_of, opened = queue.buckets.get, queue.open
        found = np.flatnonzero(first >= 0)
        self._open_all(first[found], found)
        ids = memoryview(symbols)
        end = memoryview(ends)  # end[i]: where the symbol that starts at i ends; 0 once merged away and in gaps
        before = memoryview(befores)  # before[i]: start of the symbol (or gap) before the one that starts at i
        pair = memoryview(first)  # pair[i]: rank of the symbol at i with the next one; negative without a token
        while queue.top:
            rank, bucket = queue.pop()
            if len(bucket) >= WIDE and self._merge_wide(rank, bucket, symbols, ends, befores, first):
                continue
            for at, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale: one of the two symbols has changed
                j = end[i]
                k = end[j]
                end[i], end[j], before[k], ids[i], pair[j] = k, 0, i, rank, -1
                lesser = False
                stop, h = end[k], before[i]
                r = pair[i] = get(data[i:stop], -1) if stop else -1
                if r >= 0:
                    if (held := bucket_of(r)) is not None:
                        held.append(i)
                    else:
                        opened(r, [i])
                        lesser = r < rank
                if end[h]:
                    r = pair[h] = get(data[h:k], -1)
                    if r >= 0:
                        if (held := bucket_of(r)) is not None:
                            held.append(h)
                        else:
                            opened(r, [h])
                            lesser = lesser or r < rank
                if lesser and at + 1 < len(bucket):
                    opened(rank, bucket[at + 1 :])
                    break
        kept = ends != 0
        out = symbols.astype("<u4")[kept].tobytes()
        stops = (4 * np.cumsum(kept)[gaps]).tolist()
        return [out[i:j] for i, j in zip([0, *stops], stops)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        data = [p.encode("utf-8") for p in pieces]
        out = list(map(self.whole.get, data))
        rest = [k for k, ids in enumerate(out) if ids is None]
        if rest:
            for k, ids in zip(rest, self.merge([data[k] for k in rest])):
                out[k] = ids
        return out

    def encode(self, texts) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.encode_texts(texts)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of encoded ids."""
        i = np.frombuffer(ids, "<u4").astype(np.int64)
        sizes = self.sizes[i]
        stops = np.cumsum(sizes)
        return self.blob[np.repeat(self.starts[i] - stops + sizes, sizes) + np.arange(stops[-1] if len(i) else 0)].tobytes()


def coder(path: str, pattern: str) -> ByteBpe:
    """This worker's coder for a file of ranks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path, pattern)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids`` (binary, little-endian unsigned 32-bit)."""

    @pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        own = coder(path, pattern)
        return pd.Series(own.encode(texts), dtype=object)

    return doc_columns(docs, id_col, text_col).select("doc_id", run("text").alias("ids"))


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the decoded ``bytes`` of its ids (null ids: null)."""

    @pandas_udf("binary")
    def run(ids: pd.Series) -> pd.Series:
        own = coder(path, pattern)
        return pd.Series([None if x is None else own.decode(bytes(x)) for x in ids], dtype=object)

    return encoded.withColumn("bytes", run(ids_col))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids, bytes``, as :func:`decode` of :func:`encode`.

    One function for both: where a plan uses ids and what is decoded from them, Spark
    would chain the two and encode every text twice."""

    @pandas_udf(row_type("ids binary, bytes binary"))
    def run(texts: pd.Series) -> pd.DataFrame:
        own = coder(path, pattern)
        ids = own.encode(texts)
        return pd.DataFrame({"ids": ids, "bytes": [own.decode(x) for x in ids]}, dtype=object)

    return doc_columns(docs, id_col, text_col).select("doc_id", run("text").alias("both")).select("doc_id", "both.*")
