"""Quality rules: base counts and zstandard compression bands.

The base rule looks at word and repetition counts.  The method compresses the
whole text and its fixed chunks with zstandard; a text whose ratio (plain bytes
over compressed bytes) lies outside the limits for its length is rejected as
repetitive (above) or incompressible (below), and so is one of which most bytes
lie in chunks outside the chunk limits.

Defined results: null and empty texts have no words, fail the base rule and are
not kept; an empty table gives no rows; repeated rows are judged alike; columns
other than id and text are not read.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import SPACES, doc_columns, row_type, ship

#: (texts of fewer bytes, least ratio, greatest ratio).  Short texts compress less,
#: so their limits are lower; below 128 bytes prose and base64 have the same ratio.
#: The least ratios lie just under those of prose in Latin letters: above base64
#: from 256 bytes on, random letters from 2,048 on and hex from 8,192 on.
BANDS = (
    (128, 0.0, 3.0), (256, 1.05, 4.0), (512, 1.15, 4.0), (1024, 1.35, 5.0), (2048, 1.5, 5.0), (4096, 1.7, 6.0), (8192, 1.75, 6.0),
    (16384, 1.95, 7.0), (65536, 2.05, 7.0), (float("inf"), 2.1, 8.0),
)
CHUNK = 2048
CHUNK_BAND = (1.7, 5.0)
#: The same where this share of the bytes or more is not ASCII: Chinese prose has
#: 1.08 at 300 bytes and 1.39 at 1,200.
WIDE = 0.3
WIDE_BANDS = ((128, 0.0, 3.0), (512, 1.05, 4.0), (2048, 1.2, 5.0), (8192, 1.4, 6.0), (65536, 1.5, 7.0), (float("inf"), 1.6, 8.0))
WIDE_CHUNK_BAND = (1.2, 5.0)
ASCII = bytes(range(128))
#: Share of a text's bytes in chunks outside their limits from which it goes.
CHUNK_SHARE = 0.5
LEVEL = 3

JUDGED = row_type(
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, odd_share double, kept boolean"
)


def repeat_words(words: list[bytes], n: int = 5) -> int:
    """Words that lie in an ``n``-word window found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(n))))
    if len(set(windows)) == len(windows):
        return 0
    seen, total, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + n - max(i, end)
            end = i + n
    return total


def counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    words = data.split()
    lines = Counter(x for x in text.split("\n") if x.strip(SPACES)) if text else {}
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(data.count(c) for c in b"#*$%&|<>"),
        sum(lines.values()) - len(lines),
        repeat_words(words),
    )


def wide(data: bytes) -> bool:
    return len(data.translate(None, ASCII)) >= WIDE * len(data)


def bands(data: bytes, press) -> tuple[float, float, bool]:
    """Ratio of the whole, share of bytes in odd chunks, and whether both are within limits."""
    if not data:
        return 0.0, 0.0, False
    ratio = len(data) / len(press(data))
    low, high = next((lo, hi) for below, lo, hi in (WIDE_BANDS if wide(data) else BANDS) if len(data) < below)
    odd = full = 0
    for i in range(0, len(data) - CHUNK + 1, CHUNK):
        part = data[i : i + CHUNK]
        full += 1
        least, most = WIDE_CHUNK_BAND if wide(part) else CHUNK_BAND
        odd += not least <= CHUNK / len(press(part)) <= most
    share = odd / full if full else 0.0
    return ratio, share, low <= ratio <= high and share < CHUNK_SHARE


@pandas_udf(JUDGED)
def judge(texts: pd.Series) -> pd.DataFrame:
    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
    rows = []
    for text in texts:
        text = text or ""
        data = text.encode("utf-8")
        n, chars, symbols, dup, rep = counts(text, data)
        failed = n < 10 or 100 * rep > 20 * n
        ratio, share, good = bands(data, press)
        rows.append((n, chars, symbols, dup, rep, failed, ratio, share, good and not failed))
    return pd.DataFrame(rows, columns=JUDGED.names)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts, ``base_failed``, ratios and ``kept``."""
    return doc_columns(docs, id_col, text_col).select("doc_id", judge("text").alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject; no shuffle."""
    ship(docs.sparkSession)
    return docs.where(judge(F.col(text_col).cast("string"))["kept"])
