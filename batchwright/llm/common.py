"""Helpers shared by the operators: staging, word splitting, components."""

from __future__ import annotations

import tempfile
import zipfile
from itertools import chain
from pathlib import Path

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchwright.session import scratch_dir

#: Characters that separate words (fixed by the contracts: space and TAB..CR).
SPACES = " \t\n\x0b\x0c\r"

#: Unicode White_Space, written out so that every regex library agrees on it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}


def row_type(fields: str) -> T.StructType:
    """Struct type of ``name type, ...``; needs no session, so modules can declare UDFs."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in fields.split(","))])


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once a session.

    Needed where executors were not given the package (``--py-files``)."""
    if getattr(spark, "_batchwright_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    file = Path(tempfile.mkdtemp(prefix="batchwright-code-")) / "batchwright_code.zip"
    with zipfile.ZipFile(file, "w") as z:
        for f in sorted((root / "batchwright").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(file))
    spark._batchwright_shipped = True


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage: whoever reads the result after an executor is lost reads
    the files again instead of computing the rows again.  So the shuffle files of the
    write are of no more use, and Spark is told to delete them when it ends, not when
    the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/rows"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 bytes (null: none).

    ``bytes.split()`` splits at exactly these six ASCII characters."""
    return text.encode("utf-8").split() if text else []


def doc_columns(docs: DataFrame, id_col: str, text_col: str, empty_nulls: bool = True) -> DataFrame:
    """Only ``doc_id`` and ``text``, so other columns of any name cannot clash."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), (F.coalesce(text, F.lit("")) if empty_nulls else text).alias("text"))


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str | None]]:
    """``docs`` with its columns named by place, so that no helper column clashes with
    one of them, and what ``names`` are called there (None: no such column).

    ``out.select(*that.columns).toDF(*docs.columns)`` gives the names back."""
    at: dict[str, str] = {}
    for i, c in enumerate(docs.columns):
        at.setdefault(c, f"c{i}")
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [at.get(n) for n in names]


def whitespace_pattern(pattern: str) -> str:
    """``pattern`` with ``\\s`` and ``\\S`` spelled out as :data:`WHITE`."""
    return pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: ``(node, root)``, root the least node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014), each
    staged.  A round only takes a minimum per node, combined map-side, and joins
    it back to the edges, so a node with very many edges is never gathered.
    Stops when a round changes nothing.  Nodes without an edge are not returned.
    """
    state = staged(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "components"
    )
    seen = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        state = staged(small.select("e.*").where("u <> v").distinct(), "components")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


class ChunkEncoder:
    """Encodes whole texts through bounded caches of space-delimited chunks.

    A single space before a visible character always starts a new match of the
    pre-token pattern, and its matches cover the whole text, so a text is cut there and
    each chunk (the space and what follows) encoded on its own; many chunks are matched in one go.  ``encode_pieces`` turns a list of matches into
    the encoded bytes of each; it gets all matches of a block of texts that the
    caches do not hold at once.  A block has about ``block`` characters, or is one
    longer text.  A cache that holds ``limit`` chunks or ``piece_limit`` matches after a block
    starts afresh.
    """

    def __init__(self, pattern: str, encode_pieces, limit: int = 1_200_000, piece_limit: int = 300_000, block: int = 1_000_000):
        self.find = regex.compile(whitespace_pattern(pattern)).findall
        self.uneven = regex.compile(rf" (?:[{WHITE}]|\Z)").search
        self.cut = regex.compile(f" (?=[^{WHITE}])").split
        self.encode_pieces, self.limit, self.piece_limit, self.block = encode_pieces, limit, piece_limit, block
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _look_up(self, rest: list[str]) -> tuple[list, list[str]]:
        """What the cache holds of each chunk (None: nothing), and the chunks that it lacks."""
        found = list(map(self.chunks.get, rest))
        return found, [w for w, x in zip(rest, found) if x is None] if None in found else []

    def _matches(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """The matches in all ``chunks``, and how many the chunks up to each one have."""
        flat = self.find("".join([" " + w for w in chunks]))
        stops = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))
        wanted = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)
        return flat, (np.searchsorted(stops, wanted) + 1).tolist()

    def _encode_new(self, new: list[str]) -> None:
        """Caches the matches ``new``, encoded."""
        self.pieces.update(zip(new, self.encode_pieces(new)))

    def _learn(self, chunks: set[str], firsts: list[str]) -> list[bytes]:
        """Caches the encoded ``chunks``; the encoded ``firsts``."""
        begun, chunks = [self.find(x) for x in firsts], list(chunks)
        flat, stops = self._matches(chunks)
        # asked one by one: a set less a view of keys goes through all that the cache holds
        self._encode_new([x for x in {*flat, *chain.from_iterable(begun)} if x not in self.pieces])
        piece = self.pieces.__getitem__
        ids = list(map(piece, flat))
        self.chunks.update((w, ids[i] if j == i + 1 else b"".join(ids[i:j])) for w, i, j in zip(chunks, [0, *stops], stops))
        return [b"".join(map(piece, x)) for x in begun]

    def _block(self, texts: list[str]) -> list[bytes]:
        firsts, rows, missing = [], [], set()
        for text in texts:
            first, *rest = text.split(" ")
            found, lacks = self._look_up(rest)
            if lacks and self.uneven(text):
                first, *rest = self.cut(text)
                found, lacks = self._look_up(rest)
            missing.update(lacks)
            firsts.append(first)
            rows.append((rest, found) if lacks else (None, b"".join(found)))
        begun, chunks = self._learn(missing, firsts), self.chunks
        out = [
            first + (found if rest is None else b"".join([chunks[w] if x is None else x for w, x in zip(rest, found)]))
            for first, (rest, found) in zip(begun, rows)
        ]
        self._trim()
        return out

    def _trim(self) -> None:
        for cache, limit in ((self.chunks, self.limit), (self.pieces, self.piece_limit)):
            if len(cache) >= limit:
                cache.clear()

    def __call__(self, texts) -> list[bytes]:
        """Encoded bytes of each text."""
        out, block, size = [], [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= self.block:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block) if block else out
