"""Best-fit packing of token sequences, improved by swap-based local search.

A document's ids end with an end-of-text id.  A document of more than
``capacity`` ids is cut into pieces of ``capacity``, the first of which may be
shorter; other documents are one piece.  Full pieces fill a sequence alone.  The
others are dealt by hash into shards of about ``SHARD`` pieces, packed
best-fit decreasing, and improved by local search: documents are moved, or
exchanged one for one or two for one (either way), from the emptiest bins into fuller ones,
each time raising the sum of squared fills, until no exchange helps or the number of
bins is the least that can hold all.  A shard can
waste part of its own last bins only, about one bin in several thousand.

Ids come from a byte-level BPE tokenizer file, read where its path points on each
executor.  Words repeat, so each Python worker keeps a bounded cache of encoded
chunks (:class:`~batchwright.llm.common.ChunkEncoder`).

Defined results: null and empty texts are the end id alone, a piece of length
one; an empty table gives no rows; repeated rows and rows with null ids are
packed like any other; other columns are not read; a very long text is cut as
any other and only its own ids are ever held together.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import ChunkEncoder, doc_columns, staged

CAPACITY = 1024
END_ID = 2
#: Pieces in a shard, on average.
SHARD = 16384
#: Bins that the local search tries to empty at a time.
DONORS = 64

_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str, pattern: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file: texts to little-endian 32-bit ids."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        tokenize, table = tok.model.tokenize, byte_letters()
        ids = [i.to_bytes(4, "little") for i in range(max(tok.get_vocab().values()) + 1)]

        def encode(pieces: list[str]) -> list[bytes]:
            # U+2028 stands for no byte, so it keeps the pieces apart while all are translated at once
            letters = "\u2028".join([p.encode("utf-8").decode("latin-1") for p in pieces]).translate(table).split("\u2028")
            return [b"".join([ids[t.id] for t in tokenize(x)]) for x in letters] if pieces else []

        _ENCODERS[path] = ChunkEncoder(pattern, encode)
    return _ENCODERS[path]


def byte_letters() -> dict[int, int]:
    """The visible letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 for itself, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


PIECE = T.ArrayType(
    T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of an encoded document."""
    n = len(ids) // 4
    first = n if n <= capacity else n % capacity or capacity
    edges = [0, *range(first, n + 1, capacity)]
    return [(k, i, j - i, zlib.crc32(ids[4 * i : 4 * j])) for k, (i, j) in enumerate(zip(edges, edges[1:]))]


def pieces(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document."""
    end = np.array([end_id], "<u4").tobytes()

    @pandas_udf(PIECE)
    def cut_texts(texts: pd.Series) -> pd.Series:
        encode = encoder(path, pattern)
        return pd.Series([cut(ids + end, capacity) for ids in encode(texts)], dtype=object)

    return doc_columns(docs, id_col, text_col).select("doc_id", F.explode(cut_texts("text")).alias("p")).select("doc_id", "p.*")


class Bins:
    """Bins of documents (index, size), with moves between them."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.fill = capacity, [], []

    def best_fit(self, sizes: list[int]) -> None:
        """Best-fit decreasing; a bit mask of free spaces finds the tightest bin."""
        by_free: dict[int, list[int]] = {}
        mask = 0
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            size = sizes[i]
            fits = mask >> size
            if fits:
                free = size + (fits & -fits).bit_length() - 1
                b = by_free[free].pop()
                if not by_free[free]:
                    mask &= ~(1 << free)
            else:
                free, b = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[b].append((size, i))
            self.fill[b] += size
            if free > size:
                by_free.setdefault(free - size, []).append(b)
                mask |= 1 << (free - size)

    def improve(self, donors: int = DONORS) -> None:
        """Local search until no exchange raises the sum of squared fills, or no bin can go.

        Each bin exchanges with the ``donors`` emptiest ones first.  When that helps
        nowhere, with the next blocks of emptier bins, as far as some emptier bin holds
        what it can use; the search ends with a round in which none does."""
        total, widely = sum(self.fill), False
        while True:
            live = [b for b, f in enumerate(self.fill) if 0 < f < self.capacity]
            if len([f for f in self.fill if f]) * self.capacity - total < self.capacity or len(live) < 2:
                return  # no bin can go
            live.sort(key=lambda b: self.fill[b])
            if widely:
                changed = self._exchange_widely(live, donors)
            else:
                changed = any([self._fill_up(live[k], live[: min(k, donors)]) for k in range(len(live) - 1, 0, -1)])
            if widely and not changed:
                return
            widely = not changed

    def _exchange_widely(self, live: list[int], donors: int) -> bool:
        """One round over ``live`` (emptiest first), each bin with block after block of those no fuller."""
        offers, one, two = [(0, 0)], 0, 0  # bit masks: sizes of documents and of pairs in the bins before each
        for b in live:
            own, pairs = self._sizes(b)
            one, two = reduce(or_, (1 << x for x in own), one), reduce(or_, (1 << x for x in pairs), two)
            offers.append((one, two))
        fills = [self.fill[b] for b in live]
        changed = False
        for k in range(len(live) - 1, -1, -1):
            upto = bisect_right(fills, fills[k])
            if self._useful(live[k], *offers[upto]):
                changed |= any(self._fill_up(live[k], live[n : min(upto, n + donors)]) for n in range(0, upto, donors))
        return changed

    def _sizes(self, b: int) -> tuple[set[int], set[int]]:
        """Sizes of a bin's documents, and of its pairs of documents."""
        held = [x[0] for x in self.items[b]]
        return set(held), {x + y for i, x in enumerate(held) for y in held[:i]}

    def _useful(self, b: int, one: int, two: int) -> bool:
        """Whether an exchange for one document, or for a pair, of these sizes could make bin ``b`` fuller."""
        own, pairs = self._sizes(b)
        gains = (1 << (self.capacity - self.fill[b])) - 1
        return any(one >> (out + 1) & gains for out in {0} | own | pairs) or any(two >> (out + 1) & gains for out in own)

    def _fill_up(self, b: int, give: list[int]) -> bool:
        """Exchange with the emptier bins ``give`` while bin ``b`` gets fuller."""
        changed = False
        while (free := self.capacity - self.fill[b]) and (best := self._best(b, free, give)):
            out, into, d = best
            for x in out:
                self.items[b].remove(x)
                self.items[d].append(x)
            for x in into:
                self.items[d].remove(x)
                self.items[b].append(x)
            gain = sum(x[0] for x in into) - sum(x[0] for x in out)
            self.fill[b] += gain
            self.fill[d] -= gain
            changed = True
        return changed

    def _best(self, b: int, free: int, give: list[int]):
        """(documents out of b, documents in, from which bin) of the greatest gain up to ``free``:
        one moved in, one for one, two for one or one for two."""
        ones: dict[int, tuple] = {}
        twos: dict[int, tuple] = {}
        mask1 = mask2 = 0
        for d in give:
            if self.fill[d] <= self.fill[b] and d != b:
                held = self.items[d]
                for i, x in enumerate(held):
                    if x[0] not in ones:
                        ones[x[0]] = ((x,), d)
                        mask1 |= 1 << x[0]
                    for y in held[:i]:
                        if (size := x[0] + y[0]) not in twos:
                            twos[size] = ((x, y), d)
                            mask2 |= 1 << size
        own = self.items[b]
        singles = [(x,) for x in own]
        pairs = [(x, y) for i, x in enumerate(own) for y in own[:i]]
        gain, best = 0, None
        for outs, mask, offered in (([()] + singles + pairs, mask1, ones), (singles, mask2, twos)):
            for out in outs:
                size = sum(x[0] for x in out)
                most = (mask & ((1 << (size + free + 1)) - 1)).bit_length() - 1
                if most - size > gain:
                    gain, best = most - size, (out, *offered[most])
                    if gain == free:
                        return best
        return best


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of positions in ``sizes``; every size is at most ``capacity``."""
    bins = Bins(capacity)
    bins.best_fit(sizes)
    bins.improve()
    return [[i for _, i in b] for b in bins.items if b]


def best_fit_packing(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, shard: int = SHARD, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cutted = staged(pieces(docs, path, pattern, id_col, text_col, capacity, end_id), "pieces")
    rest = cutted.where(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard))
    schema = cutted.schema.add("sequence_id", "long").add("offset", "long")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        base = int(pdf["__shard"].iloc[0]) << 32
        bins = pack(pdf["length"].tolist(), capacity)
        order = np.array([i for b in bins for i in b])
        out = pdf.iloc[order].drop(columns="__shard")
        out["sequence_id"] = np.repeat(np.arange(len(bins)) + base, [len(b) for b in bins])
        out["offset"] = out.groupby("sequence_id")["length"].cumsum() - out["length"]
        return out[[f.name for f in schema.fields]]

    # dealt by row, so repeated rows and null ids spread like any others
    dealt = rest.withColumn("__shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    packed = dealt.groupBy("__shard").applyInPandas(fill, schema)
    full = cutted.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.unionByName(packed)
