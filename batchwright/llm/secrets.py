"""Secret scans: fixed patterns, and guess costs of credential values.

The base patterns find assignments, access keys and long hex runs.  The method
takes every value that follows a credential word, finds the cheapest way for a
guesser to spell it (dynamic programming over words, dates, repeats, keyboard
walks and brute-force spans) and reports values that cost at least
``MIN_COST`` powers of ten of guesses.

Spans are ``(kind, start, end)`` in code points, end exclusive, ordered by start
and then kind in the order of :data:`KINDS`.  A guess span that lies within a
base span is left out, as that span already covers it.

Defined results: null and empty texts have no spans; an empty table gives no
rows; repeated rows get the same spans; columns other than id and text are not
read.  A text is scanned whole, however long.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .common import aside, doc_columns, row_type, ship

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Words that make what follows ``:``, ``=`` or "is" a credential value.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|(?:api|access|private)[ _-]?key)["']?(?:\x20*(?:=>|:=|[:=])\x20*|\x20is\x20)["'`]?([^\s"'`<>,;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
#: At least one of these lower-case strings stands in every text with a context.
HINTS = (b"passw", b"passp", b"passc", b"pwd", b"secret", b"token", b"credential", b"key")
#: log10 of the guesses from which a value counts as a secret.
MIN_COST = 10.0

#: Rows of keyboards, and common password words by rank.
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "qwertzuiop", "azertyuiop")
WORDS = (
    "password pass word admin user login welcome secret token key letmein dragon monkey master sunshine shadow football "
    "baseball princess summer winter spring autumn love hello world test testing demo example sample default changeme "
    "change me your my the this that insert here value string none null true false root guest temp public private access "
    "code data server client service account email name home house money michael jordan harley ranger hunter thomas "
    "computer internet super magic batman superman freedom whatever trust flower cheese coffee orange banana silver gold "
    "january february march april june july august september october november december monday tuesday wednesday thursday "
    "friday saturday sunday required optional placeholder redacted hidden removed unknown"
).split()
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
SEGMENT = 32

_RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
_WORD_SIZES = sorted({len(w) for w in WORDS})
_WALKS = [r + "\0" + r[::-1] for r in KEY_ROWS]
#: Cost of starting one more segment, so that splitting is never free.
_SPLIT = math.log10(2)


def _symbol_cost(c: str) -> float:
    """log10 of the size of the class that a guesser tries for one character."""
    if "0" <= c <= "9":
        return 1.0
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26)
    return math.log10(33) if c < "\x80" else 2.0


def guess_cost(value: str) -> float:
    """log10 of the least number of guesses that some segmentation of ``value`` needs.

    ``best[i]`` is the least cost of the first ``i`` characters; each step adds
    one segment that ends at ``i``.  Segments other than repeats are at most
    ``SEGMENT`` long, so the work grows linearly with the value."""
    low, n = value.lower(), len(value)
    if len(low) != n:
        low = value
    best, spell = [0.0] * (n + 1), [0.0]
    for c in value:
        spell.append(spell[-1] + _symbol_cost(c))
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            dates.setdefault(m.end(), []).append(i)
    walk = [0] * len(_WALKS)
    run, open_span = 0, math.inf
    for i in range(1, n + 1):
        # a brute-force span that is open costs its characters and one split
        open_span = min(open_span, best[i - 1] + _SPLIT - spell[i - 1])
        cost = open_span + spell[i]
        for size in _WORD_SIZES:
            if size > i:
                break
            rank = _RANK.get(low[i - size : i])
            if rank is not None:
                upper = 0.0 if value[i - size : i] == low[i - size : i] else math.log10(2)
                cost = min(cost, best[i - size] + rank + upper + _SPLIT)
        for j in dates.get(i, ()):
            cost = min(cost, best[j] + math.log10(365 * (i - j > 4) * 200 or 200) + _SPLIT)
        run = run + 1 if i > 1 and value[i - 1] == value[i - 2] else 1
        if run >= 3:
            cost = min(cost, best[i - run] + _symbol_cost(value[i - 1]) + math.log10(run) + _SPLIT)
        for size in range(2, min(SEGMENT, i // 2) + 1):
            block = low[i - size : i]
            if low[i - 2 * size : i - size] == block:
                times = 2
                while times < SEGMENT and low[max(0, i - (times + 1) * size) : i - times * size] == block:
                    times += 1
                start = i - times * size
                once = min(spell[start + size] - spell[start], best[start + size] - best[start])
                cost = min(cost, best[start] + max(once, 0.0) + math.log10(times) + _SPLIT)
        for k, row in enumerate(_WALKS):
            last = low[max(0, i - walk[k] - 1) : i]
            while last and last not in row:
                last = last[1:]
            walk[k] = len(last)
            if walk[k] >= 3:
                cost = min(cost, best[i - walk[k]] + math.log10(len(_WALKS) * len(row) * walk[k]) + _SPLIT)
        best[i] = cost
    return best[n]


@lru_cache(1 << 14)
def _costs_enough(value: str, least: float) -> bool:
    return guess_cost(value) >= least


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns."""
    data = text.encode("utf-8").lower()
    found = []
    if any(h in data for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, base: list[tuple[int, int, int]], least: float = MIN_COST) -> list[tuple[int, int, int]]:
    """(start, kind, end) of credential values that cost ``least`` or more and lie in no base span."""
    data = text.encode("utf-8").lower()
    if not any(h in data for h in HINTS):
        return []
    out, k, reach = [], 0, -1
    for m in CONTEXT.finditer(text):
        i, j = m.span(1)
        while j > i and text[j - 1] in ".!?)]}":
            j -= 1
        while k < len(base) and base[k][0] <= i:
            reach = max(reach, base[k][2])
            k += 1
        if j <= reach or j - i < 6:
            continue
        if _costs_enough(text[i:j], least):
            out.append((i, 3, j))
    return out


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for i, k, j in spans)


FOUND = row_type("n_assign long, n_access long, n_hex long, base_spans string, spans string")


@pandas_udf(FOUND)
def scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text or ""
        base = base_spans(text)
        kinds = [k for _, k, _ in base]
        rows.append((kinds.count(0), kinds.count(1), kinds.count(2), listed(base), listed(sorted(base + guess_spans(text, base)))))
    return pd.DataFrame(rows, columns=FOUND.names)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, base spans and all spans."""
    return doc_columns(docs, id_col, text_col).select("doc_id", scan("text").alias("s")).select("doc_id", "s.*")


#: What a redacted span becomes; itself no secret.
MASK = "[SECRET]"


def redact(text: str | None) -> str | None:
    """The text with every span, overlapping ones merged, replaced by :data:`MASK`."""
    if not text:
        return text
    base = base_spans(text)
    spans = sorted(base + guess_spans(text, base))
    if not spans:
        return text
    out, at, end = [], 0, -1
    for i, _, j in spans:
        if i >= end:
            out += [text[at:i], MASK]
        at = end = max(end, j)
    return "".join(out) + text[at:]


@pandas_udf(StringType())
def redacted(texts: pd.Series) -> pd.Series:
    return pd.Series([redact(t) for t in texts], dtype=object)


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in the text; a length column, if there, follows the new text."""
    ship(docs.sparkSession)
    names = docs.columns
    docs, (text_col, length_col) = aside(docs, text_col, length_col)
    out = docs.withColumn("__text", redacted(F.col(text_col).cast("string")))
    changed = ~F.col("__text").eqNullSafe(F.col(text_col))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("__text").alias(c))
        elif c == length_col:
            cols.append(F.when(changed, F.length("__text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols).toDF(*names)
