"""Vector code compression: product quantization with exact integer codebooks.

Vectors become integers and are cut into equal parts; every part has a codebook,
trained by a few rounds of nearest assignment and floored means, and a vector is
stored as its parts' codebook indexes.

Vectors are taken ``CHUNK`` at a time as the input's partitions hold them, without
a shuffle.  Within a chunk each part's points are sorted along a Hilbert curve and
cut into flat blocks of ``FLAT`` points, each with its box (least and greatest
components) and its component sums.  Each round

* the distances of a box to an entry bound those of its points.  An entry whose
  least distance exceeds the smallest greatest distance of any entry is nobody's
  nearest; the others are the block's shortlist;
* a block with a single-entry shortlist counts whole, by its sums;
* the others are evaluated against their shortlists only, by exact integer
  kernels (ties to the lower index, as shortlists keep the codebook's order).

Tasks hand on sums per entry, combined before the shuffle; only codebooks pass
through the driver: ``ENTRIES`` x dimension integers, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_type, ship, staged

CHUNK, FLAT = 16384, 64
#: Columns of a stored chunk beside its ids and labels.
STORED = ["points", "orders", "boxes", "sums"]
#: Cells of a kernel's distance table at once.
CELLS = 1 << 22
#: A label with more than this share of the rows is joined by broadcast (there are at most 1 / share of them).
HEAVY = 1 / 256


def integer_rows(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, vec``: floor(scale * x) of every component, as long; unusable vectors dropped."""
    x = F.col(vec_col)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    grid = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return rows.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), grid.alias("vec"))


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each point (rows of non-negative integers) on a Hilbert curve.

    Skilling's transposed form (2004), vectorised over the points.  The curve has
    as many bits a dimension as 62 bits allow; lower bits are cut off."""
    n, dims = points.shape
    if dims > 62:
        points, dims = points[:, :62], 62
    bits = max(1, 62 // max(dims, 1))
    top = int(points.max(initial=0)).bit_length()
    bits, x = min(bits, max(top, 1)), (points >> max(0, top - bits)).astype(np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            up = (x[:, i] & q) != 0
            t = np.where(up, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(up, p, t)
            x[:, i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


class Blocks:
    """One part of one chunk: points in Hilbert order in flat blocks, with boxes and sums."""

    def __init__(self, points: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        n, self.dims = points.shape
        self.points, self.order, self.low, self.high, self.sums = points, order, low, high, sums
        self.starts = np.arange(0, n, FLAT)
        self.sizes = np.diff(np.append(self.starts, n))

    @staticmethod
    def of(points: np.ndarray) -> Blocks:
        order = np.argsort(hilbert_keys(points - points.min(axis=0)), kind="stable")
        points, starts = points[order], np.arange(0, len(points), FLAT)
        return Blocks(points, order, *(f.reduceat(points, starts) for f in (np.minimum, np.maximum, np.add)))

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """blocks x entries: whether the entry may be the nearest of a point of the block."""
        least, most = (np.zeros((len(self.starts), len(book)), np.int64) for _ in range(2))
        for d in range(self.dims):
            c, low, high = book[:, d], self.low[:, d, None], self.high[:, d, None]
            outside = np.maximum(np.maximum(low - c, c - high), 0)
            far = np.maximum(np.abs(c - low), np.abs(high - c))
            least += outside * outside
            most += far * far
        return least <= most.min(axis=1)[:, None]

    def nearest(self, book: np.ndarray, blocks: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the points of ``blocks``: their places, nearest entries and squared distances."""
        sizes = listed.sum(axis=1)
        places, codes, errors = [], [], []
        by_size = blocks[np.argsort(sizes[blocks], kind="stable")]
        i = 0
        while i < len(by_size):
            j = i + 1  # blocks of similar shortlists, filled up to the longest
            while j < len(by_size) and (j - i) * FLAT * sizes[by_size[j]] < CELLS and sizes[by_size[j]] <= sizes[by_size[i]] + 4:
                j += 1
            group = by_size[i:j]
            i, width = j, int(sizes[group[-1]])
            entries = np.argsort(~listed[group], axis=1, kind="stable")[:, :width]
            blank = ~np.take_along_axis(listed[group], entries, 1)
            at = self.starts[group][:, None] + np.arange(FLAT)
            real = np.arange(FLAT) < self.sizes[group][:, None]
            at = np.where(real, at, self.starts[group][:, None])
            cost = np.zeros((len(group), FLAT, width), np.int64)
            for d in range(self.dims):
                gap = self.points[at, d][:, :, None] - book[entries, d][:, None, :]
                gap *= gap
                cost += gap
            np.copyto(cost, np.iinfo(np.int64).max, where=blank[:, None, :])
            best = cost.argmin(axis=2)
            places.append(at[real])
            codes.append(np.take_along_axis(entries, best, 1)[real])
            errors.append(np.take_along_axis(cost, best[:, :, None], 2)[:, :, 0][real])
        if not places:
            return (np.empty(0, np.int64),) * 3
        return np.concatenate(places), np.concatenate(codes), np.concatenate(errors)

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and component sums of each entry."""
        listed = self.shortlists(book)
        whole = listed.sum(axis=1) == 1
        count, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        entry = listed.argmax(axis=1)[whole]
        np.add.at(count, entry, self.sizes[whole])
        np.add.at(sums, entry, self.sums[whole])
        places, codes, _ = self.nearest(book, np.flatnonzero(~whole), listed)
        count += np.bincount(codes, minlength=len(book))
        np.add.at(sums, codes, self.points[places])
        return count, sums

    def assigned(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each point, in the chunk's own order."""
        code, error = np.empty(len(self.points), np.int64), np.empty(len(self.points), np.int64)
        places, codes, errors = self.nearest(book, np.arange(len(self.starts)), self.shortlists(book))
        code[self.order[places]], error[self.order[places]] = codes, errors
        return code, error


class Layout:
    """Sizes that all chunks and codebooks share."""

    def __init__(self, dim: int, top: int, parts: int):
        self.parts, self.width = parts, max(1, -(-dim // parts))
        if self.parts * self.width * (2 * top) ** 2 >= 1 << 62:
            raise OverflowError(f"{dim} components up to {top}: squared distances do not fit 64 bits")
        self.stored = np.dtype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)

    def cut(self, column: pa.ListArray) -> np.ndarray:
        """rows x parts x width; shorter vectors filled up with zeros."""
        n, dim = len(column), self.parts * self.width
        sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
        flat = column.flatten().to_numpy(zero_copy_only=False)
        if (sizes == dim).all():
            return flat.reshape(n, self.parts, self.width)
        out = np.zeros((n, dim), np.int64)
        out[np.arange(dim) < sizes[:, None]] = flat
        return out.reshape(n, self.parts, self.width)

    def write(self, blocks: list[Blocks]) -> list[bytes]:
        """Columns of a stored chunk, all parts in turn."""
        kinds = {"points": self.stored, "orders": np.uint16, "boxes": self.stored, "sums": np.int64}
        columns = {
            "points": [b.points for b in blocks],
            "orders": [b.order for b in blocks],
            "boxes": [x for b in blocks for x in (b.low, b.high)],
            "sums": [b.sums for b in blocks],
        }
        return [b"".join(x.astype(kinds[c]).tobytes() for x in columns[c]) for c in STORED]

    def read(self, points: bytes, orders: bytes, boxes: bytes, sums: bytes) -> list[Blocks]:
        order = np.frombuffer(orders, np.uint16).reshape(self.parts, -1).astype(np.int64)
        shape = (self.parts, -1, self.width)
        points = np.frombuffer(points, self.stored).reshape(shape).astype(np.int64)
        sums = np.frombuffer(sums, np.int64).reshape(shape)
        boxes = np.frombuffer(boxes, self.stored).reshape(self.parts, 2, -1, self.width).astype(np.int64)
        return [Blocks(points[p], order[p], boxes[p, 0], boxes[p, 1], sums[p]) for p in range(self.parts)]


def chunks(rows: DataFrame, layout: Layout) -> DataFrame:
    """One row a chunk: its ids and labels, and every part's points in Hilbert order, boxes and sums."""
    kinds = {c: rows.schema[c].dataType for c in ("vec_id", "label")}
    schema = T.StructType([T.StructField(c, T.ArrayType(k)) for c, k in kinds.items()] + [T.StructField(c, T.BinaryType()) for c in STORED])

    def chunk(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        vectors = table.column("vec").combine_chunks()
        cut = layout.cut(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors)
        data = layout.write([Blocks.of(cut[:, p]) for p in range(layout.parts)])
        lists = []
        for c in kinds:
            values = table.column(c).combine_chunks()
            values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
            lists.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
        return pa.RecordBatch.from_arrays([*lists, *(pa.array([x], pa.binary()) for x in data)], names=schema.names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while len(batch):
                take = batch.slice(0, CHUNK - n)
                held.append(take)
                n, batch = n + len(take), batch.slice(len(take))
                if n == CHUNK:
                    yield chunk(pa.Table.from_batches(held))
                    held, n = [], 0
        if held:
            yield chunk(pa.Table.from_batches(held))

    return rows.select("vec_id", "label", "vec").mapInArrow(build, schema)


def next_books(stored: DataFrame, layout: Layout, books: np.ndarray) -> np.ndarray:
    """One round: floored means of the points nearest to each entry; unused entries stay."""

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for df in batches:
            for chunk in df[STORED].itertuples(index=False):
                for p, blocks in enumerate(layout.read(*chunk)):
                    n, s = blocks.totals(books[p])
                    count[p] += n
                    sums[p] += s
        part, entry = np.nonzero(count)
        for d in range(layout.width):
            yield pd.DataFrame({"part": part.astype(np.int32), "entry": entry.astype(np.int32), "d": np.int32(d), "n": count[part, entry], "s": sums[part, entry, d]})

    found = stored.select(*STORED).mapInPandas(totals, row_type("part int,entry int,d int,n long,s long"))
    out = books.copy()
    for r in found.groupBy("part", "entry", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():  # at most the codebooks' size
        out[r["part"], r["entry"], r["d"]] = r["s"] // r["n"]
    return out


def codes(stored: DataFrame, layout: Layout, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""
    fields = [T.StructField(c, stored.schema[c].dataType.elementType) for c in ("vec_id", "label")]
    schema = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    digits = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), "S2")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                ids, labels = one.column("vec_id").flatten(), one.column("label").flatten()
                code, error = np.empty((len(ids), layout.parts), np.int64), np.zeros(len(ids), np.int64)
                for p, blocks in enumerate(layout.read(*(one.column(c)[0].as_py() for c in STORED))):
                    code[:, p], e = blocks.assigned(books[p])
                    error += e
                text = np.ascontiguousarray(digits[code]).view(f"S{2 * layout.parts}").ravel().astype(str)
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error, pa.int64())], names=schema.names)

    return stored.mapInArrow(assign, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over the rows with an equal label (nulls together).

    Sums are combined before the shuffle.  The few labels with a large share of the
    rows are joined by broadcast, the others in a shuffle, where none is large."""
    sums = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")), "codes-labels")
    total = sums.agg(F.sum("rows")).first()[0] or 0
    heavy = sums.where(F.col("rows") > total * HEAVY)
    light = sums.where(F.col("rows") <= total * HEAVY)
    same = lambda other: F.col("c.label").eqNullSafe(F.col(f"{other}.label"))
    first = coded.alias("c").join(F.broadcast(heavy).alias("h"), same("h"), "left").select("c.*", "h.label_error")
    done = first.where(F.col("label_error").isNotNull())
    rest = first.where(F.col("label_error").isNull()).drop("label_error").alias("c").join(light.hint("merge").alias("l"), same("l")).select("c.*", "l.label_error")
    return done.unionByName(rest)


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """``(coded, books)``: ``vec_id, code, error, label, label_error`` of every usable
    row, and the final codebooks (parts x entries x components of a part).

    A code is two hex digits a part, so at most 256 entries.  Codebooks start as the
    ``entries`` smallest ids' vectors (nulls last, equal ids by vector); fewer rows
    give fewer entries.  Vectors that are null or hold null or non-finite components
    are dropped; vectors shorter than the longest, or than a multiple of ``parts``,
    count as filled up with zeros.  Repeated rows are coded each.  Columns other than
    the three are not read.  Empty tables give no rows and empty codebooks.
    Components that could overflow 64-bit distances are an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = rows.sparkSession
    ship(spark)
    found = integer_rows(rows, id_col, vec_col, label_col, scale)
    size = found.agg(F.max(F.size("vec")).alias("dim"), F.max(F.array_max(F.transform("vec", F.abs))).alias("top")).first()
    layout = Layout(size["dim"] or 0, size["top"] or 0, parts)
    first = found.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()  # at most ``entries`` rows
    books = np.zeros((parts, len(first), layout.width), np.int64)
    for e, r in enumerate(first):
        books[:, e] = np.pad(np.array(r["vec"], np.int64), (0, parts * layout.width - len(r["vec"]))).reshape(parts, layout.width)
    stored = staged(chunks(found, layout), "codes-chunks")
    for _ in range(rounds if len(first) else 0):
        books = next_books(stored, layout, books)
    coded = staged(codes(stored, layout, books), "codes-rows")
    return with_label_errors(coded).select("vec_id", "code", "error", "label", "label_error"), books
