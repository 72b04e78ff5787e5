"""Substring dedup: fuzzy passages shared by documents, by collinear chaining.

Method: every text gives k-mer seeds (hashes of ``k`` successive words, A-Z
lower-cased), thinned by winnowing: of each ``window`` successive k-mers the least
hash is kept, so any run of ``window + k - 1`` equal words has a seed in common.  Two
texts that hold a seed are put together (see :func:`matched_pairs`): all pairs of a
seed that occurs up to ``CAP`` times, for others all pairs that also share words next
to it.  Ordered matches of a pair of texts are chained with gap costs, Fenwick trees over
the diagonals giving the best predecessor; chains are aligned word by word on the
texts around them, and kept where at least ``least`` words match and make a share
of ``identity`` of the passage on either side.

A seed of more than ``CAP`` occurrences (a common sentence, a large family of near
copies) makes no pairs by itself: its passages of ``least`` words are one run of equal
words, or go on beyond a difference.  So each such occurrence has further keys:

* the runs of ``least`` equal words around it, each joined to the first (or the last)
  text that holds it, which holds all of it;
* the seed along with each k-mer near it.  Texts that share such a key are all put
  together where it occurs up to ``CAP`` times too; else with the first and the last one
  that hold it.  Where the latter leave the words of a key outside all passages, it
  meets every text that shares it, in a second pass.

So the words of every such passage are looked at with a text that shares them; among
more than ``CAP`` texts that share both a seed and all that is near it, and whose
passages are found already, some pairs are not put together, and not counted in
``n_partners``.  Where a pair has several chains, which ends stay is the aligner's choice.  Equal texts are one
class: only its first row is aligned.

Result: one row for each maximal passage of a document (overlapping ones united):
``doc_id, start, end`` (code points), ``n_words`` (of the longest alignment in it),
``identity`` (the best one's), ``partner_id`` (a document that holds it too) and
``n_partners`` (texts that it was aligned with).  Equal texts of ``least`` words or
more are one passage, whole; its partner is the smallest id of the class, for that
one itself the greatest.

Defined results: null, empty and shorter texts have no passages; an empty table
gives no rows; rows that repeat id and text are members of one class and give a
row each; null ids are members like others, and partners only where their class
has no other id; columns other than id and text are not read.  Texts are told apart
by their SHA-256, never by id, so repeated ids do not mix texts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf

from .common import doc_columns, row_type, staged

K = 8
WINDOW = 20
LEAST = 50
IDENTITY = 0.8
#: Cost of a chain for each word of difference between two gaps, and for each
#: word of the shorter gap, against a gain of one for each word matched.
SKEW_COST = 0.5
GAP_COST = 0.05
#: Words of any length on either side of a chain that its alignment may grow into.
REACH = 320
#: Most words between neighbouring matches of a chain.
GAP = 60
#: Most occurrences of a key that are all paired.
CAP = 32

#: Hash and word position of a seed or run, and the code points ``begin`` to ``stop`` that an alignment around it sees.
KEYS = T.ArrayType(row_type("h long, pos int, begin int, stop int"))
SEEDS = T.StructType([T.StructField("n_words", T.IntegerType()), T.StructField("n_chars", T.LongType()), T.StructField("seeds", KEYS)])
#: Hash of a seed with a k-mer near it, word positions of both, and the code points from the first to the end of the last.
NEAR = T.ArrayType(row_type("h long, pos int, at int, start int, end int"))
SHARED = T.StructType([T.StructField("runs", KEYS), T.StructField("near", NEAR)])
_MULT = np.uint64(0x9E3779B97F4A7C15)


def spots(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points where the words of a text start and end."""
    c = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    word = np.zeros(len(c) + 2, bool)
    word[1:-1] = (c != 32) & ((c < 9) | (c > 13))
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2]


def keys(text: str, h: np.ndarray, pos: np.ndarray, size: int, reach: int) -> list[np.ndarray]:
    """The fields of :data:`KEYS` of the ``size`` words at each of ``pos``."""
    if not len(h):
        return [np.zeros(0, np.int64)] * 4
    starts, ends = spots(text)
    return [h, pos, starts[np.maximum(pos - reach, 0)], ends[np.minimum(pos + size + reach, len(ends)) - 1]]


def key_lists(rows: list[list[np.ndarray]], names: list[str] = KEYS.elementType.names) -> pa.ListArray:
    """:data:`KEYS` or :data:`NEAR` of a batch of texts."""
    offsets = np.cumsum([0, *(len(r[0]) for r in rows)]).astype(np.int32)
    fields = [np.concatenate([r[c] for r in rows]).astype(np.int32 if c else np.int64) for c in range(len(names))] if rows else [np.zeros(0, np.int32 if c else np.int64) for c in range(len(names))]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(f) for f in fields], names))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def grams(each: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` successive words."""
    n = len(each) - k + 1
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        h = (h ^ each[i : i + n]) * _MULT
        h ^= h >> np.uint64(29)
    return h


def least_in(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the leftmost least value in each ``window`` successive ones."""
    at, wide = np.arange(len(h)), 1
    while wide < window:
        step = min(wide, window - wide)
        a, b = at[:-step], at[step:]
        at, wide = np.where(h[b] < h[a], b, a), wide + step
    return at


def winnow(words: list[bytes], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the kept k-mers (leftmost of equal ones)."""
    h = grams(word_hashes(words), k)
    n = len(h)
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n <= window:
        keep = np.array([int(h.argmin())])
    else:
        keep = least_in(h, window)  # never falls
        keep = keep[np.concatenate([[True], keep[1:] != keep[:-1]])]
    # in runs of one repeated k-mer each window-th stays, and two show that it repeats
    same = np.zeros(len(keep), bool)
    same[2:] = (h[keep[2:]] == h[keep[1:-1]]) & (h[keep[1:-1]] == h[keep[:-2]]) & (keep[2:] % window != 0)
    keep = keep[~same]
    return h[keep].view(np.int64), keep


def seeds_udf(k: int, window: int, reach: int):
    @arrow_udf(SEEDS)
    def run(texts: pa.Array) -> pa.Array:
        n_words, n_chars, found = [], [], []
        for text in texts.to_pylist():
            words = text.encode("utf-8").lower().split()
            h, pos = winnow(words, k, window)
            n_words.append(len(words))
            n_chars.append(len(text))
            found.append(keys(text, h, pos, k, reach))
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int32()), pa.array(n_chars, pa.int64()), key_lists(found)], SEEDS.names)

    return run


def shared_runs(words: list[bytes], common: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the runs of ``least`` words whose least k-mer hash is in ``common``.

    The least k-mer of a run is kept by :func:`winnow` in every text that holds the
    run; where it occurs up to ``CAP`` times, its match already joins both texts."""
    each = word_hashes(words)
    h, runs = grams(each, k), grams(each, least)
    if not len(runs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pos = np.flatnonzero(np.isin(h[least_in(h, least - k + 1)], common))
    return runs[pos].view(np.int64), pos


def near_keys(words: list[bytes], common: np.ndarray, k: int, window: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each seed in ``common`` along with the k-mers near it: hashes, word positions of the seed and of the k-mer.

    Near are all k-mers that an alignment can reach from the last seed of a run, or that
    make ``least`` words with the seed; and the seeds that a chain can link with it.  A
    text that repeats itself gives each key once, where it comes first."""
    h, (seeds, kept) = grams(word_hashes(words), k), winnow(words, k, window)
    mine = kept[np.isin(seeds.view(np.uint64), common)]
    by, wide = least + GAP // 4 + 1, least + GAP + k
    steps = np.array([d for d in range(-by, by + 1) if abs(d) >= k])
    pos, at = np.repeat(mine, len(steps)), (mine[:, None] + steps).ravel()
    low, high = np.searchsorted(kept, mine - wide), np.searchsorted(kept, mine + wide, "right")
    linked = [(p, q) for p, i, j in zip(mine.tolist(), low, high) for q in kept[i:j].tolist() if abs(q - p) > by]
    far = np.array(linked, np.int64).reshape(-1, 2)
    pos, at = np.concatenate([pos, far[:, 0]]), np.concatenate([at, far[:, 1]])
    inside = (at >= 0) & (at < len(h))
    pos, at = pos[inside], at[inside]
    key = (h[pos] * _MULT) ^ (h[at] + (at > pos).astype(np.uint64))
    key = (key ^ (key >> np.uint64(29))) * _MULT
    _, once = np.unique(key, return_index=True)
    return key[once].view(np.int64), pos[once], at[once]


def shared_udf(k: int, window: int, least: int, reach: int):
    """Runs and near k-mers of a text around its ``common`` seeds."""

    @arrow_udf(SHARED)
    def run(texts: pa.Array, common: pa.Array) -> pa.Array:
        runs, near = [], []
        for text, seeds in zip(texts.to_pylist(), common):
            words, seeds = text.encode("utf-8").lower().split(), np.asarray(seeds.values, dtype=np.int64).view(np.uint64)
            runs.append(keys(text, *shared_runs(words, seeds, k, least), k, reach))
            h, pos, at = near_keys(words, seeds, k, window, least)
            starts, ends = spots(text)
            near.append([h, pos, at, starts[np.minimum(pos, at)], ends[np.maximum(pos, at) + k - 1]])
        return pa.StructArray.from_arrays([key_lists(runs), key_lists(near, NEAR.elementType.names)], SHARED.names)

    return run


class Fenwick:
    """Best entry among ranks up to a given one and not before a given place.

    Entries come in the order of their places, and the places asked for never fall.
    A node holds a queue of the entries that may yet be its best: later ones push out
    earlier ones of no greater value, and those before the place asked for leave at the
    front."""

    def __init__(self, n: int):
        self.nodes = [deque() for _ in range(n + 1)]

    def enter(self, rank: int, place: int, value: float, item: int) -> None:
        while rank < len(self.nodes):
            held = self.nodes[rank]
            while held and held[-1][1] <= value:
                held.pop()
            held.append((place, value, item))
            rank += rank & -rank

    def best(self, rank: int, least: int) -> tuple[float, int]:
        value, item = -1e18, -1
        while rank > 0:
            held = self.nodes[rank]
            while held and held[0][0] < least:
                held.popleft()
            if held and held[0][1] > value:
                _, value, item = held[0]
            rank &= rank - 1
        return value, item


#: Matches chained by comparing all of them, below which halves are not split.
FEW = 16


def chains(anchors: list[tuple[int, int]], k: int = K, gap: int = GAP) -> list[list[int]]:
    """Collinear chains of matches (position in a, position in b), as lists of indices, best first.

    A link between matches with gaps ``ga`` and ``gb`` in a and b, both above zero and
    the shorter at most ``gap``, adds ``min(k, ga, gb) - SKEW_COST * |ga - gb| -
    GAP_COST * min(ga, gb)``; a match alone scores ``k``.  Every match gets its best
    predecessor: the first half of the matches (by position in a) is chained, then
    offered to the second half, which is chained last.

    With diagonals ``d = a - b``, a predecessor on ``d`` or below has its shorter gap in
    b, and being before in b it is before in a; one on ``d`` or above likewise with a and
    b changed round.  So each half is swept once along b and once along a, and a Fenwick
    tree over the diagonals gives the best predecessor within the gap: one tree for
    those ``k`` or more words back, whose words all count, one for nearer ones."""
    order = sorted(range(len(anchors)), key=lambda i: anchors[i])
    score, before = [float(k)] * len(anchors), [-1] * len(anchors)

    def offer(i: int, j: int, total: float) -> None:
        if j >= 0 and total > score[i]:
            score[i], before[i] = total, j

    def compare(part: list[int]) -> None:
        for n, i in enumerate(part):
            a, b = anchors[i]
            for j in part[:n]:
                ga, gb = a - anchors[j][0], b - anchors[j][1]
                short = ga if ga < gb else gb
                if 0 < short <= gap:
                    offer(i, j, score[j] + min(k, short) - SKEW_COST * abs(ga - gb) - GAP_COST * short)

    def sweep(first: list[int], second: list[int], side: int) -> None:
        sign = 1 if side else -1  # along b: diagonals below; along a: above
        place = {i: anchors[i][side] for part in (first, second) for i in part}
        slant = {i: sign * (anchors[i][0] - anchors[i][1]) for i in place}
        low, high = min(place[i] for i in second), max(place[i] for i in second)
        first = sorted((i for i in first if low - gap <= place[i] < high), key=place.__getitem__)
        if not first:
            return
        low, high = place[first[0]], place[first[-1]]
        second = sorted((i for i in second if low < place[i] <= high + gap), key=place.__getitem__)
        slants = sorted({slant[i] for i in first})
        near, far, entered, passed = Fenwick(len(slants)), Fenwick(len(slants)), 0, 0
        value = {i: score[i] + SKEW_COST * slant[i] + GAP_COST * place[i] for i in first}
        for i in second:
            at = place[i]
            while entered < len(first) and place[first[entered]] < at:
                j = first[entered]
                near.enter(bisect_right(slants, slant[j]), place[j], value[j] - place[j], j)
                entered += 1
            while passed < len(first) and place[first[passed]] <= at - k:
                j = first[passed]
                far.enter(bisect_right(slants, slant[j]), place[j], value[j], j)
                passed += 1
            rank, cost = bisect_right(slants, slant[i]), SKEW_COST * slant[i] + GAP_COST * at
            got, j = near.best(rank, at - min(k - 1, gap))
            offer(i, j, got - cost + at)
            got, j = far.best(rank, at - gap)
            offer(i, j, got - cost + k)

    def chain(part: list[int]) -> None:
        if len(part) <= FEW:
            return compare(part)
        first, second = part[: len(part) // 2], part[len(part) // 2 :]
        chain(first)
        sweep(first, second, 1)
        sweep(first, second, 0)
        chain(second)

    chain(order)
    used, out = [False] * len(anchors), []
    for i in sorted(range(len(anchors)), key=lambda i: -score[i]):
        linked = []
        while i >= 0 and not used[i]:
            used[i] = True
            linked.append(i)
            i = before[i]
        if linked:
            out.append(linked[::-1])
    return out


CHAIN = T.ArrayType(T.StructType([T.StructField(c, T.ArrayType(T.IntegerType()) if c in ("pa", "pb") else T.IntegerType()) for c in ("a0", "b0", "begin_a", "stop_a", "begin_b", "stop_b", "pa", "pb")]))


@arrow_udf(CHAIN)
def chain_matches(matches: pa.Array) -> pa.Array:
    """Chains of a pair's matches (two :data:`KEYS` without hash): word positions of the first
    seed, the code points to see on both sides, and word offsets of the seeds from the first one."""
    offsets = np.asarray(matches.offsets).tolist()
    rows = matches.values  # all matches of the batch, pair after pair
    pa_all, pb_all, *bounds = (np.asarray(rows.field(c)).tolist() for c in ("pa", "pb", "begin_a", "stop_a", "begin_b", "stop_b"))
    bounds = list(zip(*bounds))
    ends, found, steps, steps_a, steps_b = [0], [], [0], [], []
    for start, stop in zip(offsets, offsets[1:]):
        by = dict(zip(zip(pa_all[start:stop], pb_all[start:stop]), bounds[start:stop]))
        m = [x for x in sorted(by) if x[0] % K == 0 or (x[0] - 1, x[1] - 1) not in by]  # of matches at successive words each eighth is enough
        for c in chains(m):
            a, b = m[c[0]]
            first, last = by[m[c[0]]], by[m[c[-1]]]
            found.append((a, b, first[0], last[1], first[2], last[3]))
            steps_a += [m[i][0] - a for i in c]
            steps_b += [m[i][1] - b for i in c]
            steps.append(len(steps_a))
        ends.append(len(found))
    plain = np.array(found, np.int32).reshape(-1, 6)
    lists = [pa.ListArray.from_arrays(np.array(steps, np.int32), pa.array(x, pa.int32())) for x in (steps_a, steps_b)]
    fields = [pa.array(np.ascontiguousarray(plain[:, n])) for n in range(6)] + lists
    return pa.ListArray.from_arrays(np.array(ends, np.int32), pa.StructArray.from_arrays(fields, CHAIN.elementType.names))


def ahead(a: list[bytes], i: int, b: list[bytes], j: int, step: int = 16) -> int:
    """Equal words from ``a[i]`` and ``b[j]`` on, by whole slices first."""
    n, most = 0, min(len(a) - i, len(b) - j)
    while n + step <= most and a[i + n : i + n + step] == b[j + n : j + n + step]:
        n += step
    while n < most and a[i + n] == b[j + n]:
        n += 1
    return n


def framed(one: list[bytes], two: list[bytes]) -> tuple[int, int] | None:
    """Lengths of the common prefix and suffix where these are all :func:`matching_blocks`, else None.

    They are where no word between them is on the other side, as no other block is then
    longer or comes sooner.  With nothing between them on one side, a word that is there
    twice might begin such a block."""
    p, s = ahead(one, 0, two, 0), 0
    most = min(len(one), len(two)) - p
    while s < most and one[-1 - s] == two[-1 - s]:
        s += 1
    x, y = one[p : len(one) - s], two[p : len(two) - s]
    if not (set(x).isdisjoint(two) and set(y).isdisjoint(one)):
        return None
    if (not x and len(set(one)) < len(one)) or (not y and len(set(two)) < len(two)):
        return None
    return p, s


def equal_diagonals(one: list[bytes], two: list[bytes]) -> list[tuple[int, int, int]]:
    """Maximal runs of equal words: start in ``one``, start in ``two``, words."""
    at: dict[bytes, list[int]] = {}
    for j, w in enumerate(two):
        if w in at:
            at[w].append(j)
        else:
            at[w] = [j]
    runs, x, y = [], len(one), len(two)
    for i, places in enumerate(map(at.get, one)):
        for j in places or ():
            if i and j and one[i - 1] == two[j - 1]:
                continue  # within a run
            n, most = 1, min(x - i, y - j)
            while n < most and one[i + n] == two[j + n]:
                n += 1
            runs.append((i, j, n))
    return runs


def longest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The longest run, of equals the first in ``one``, then in ``two``."""
    x = y = size = 0
    for i, j, n in runs:
        if n > size or (n == size and (i, j) < (x, y)):
            x, y, size = i, j, n
    return x, y, size


def matching_blocks(one: list[bytes], two: list[bytes]) -> list[tuple[int, int, int]]:
    """The blocks of difflib's ``SequenceMatcher``: the longest run of equal words, and so on before and after it.

    All runs are found once and cut to the part in question, instead of searched for in every part."""
    blocks, parts = [], [equal_diagonals(one, two)]
    while parts:
        runs = parts.pop()
        x, y, size = longest(runs)
        if not size:
            continue
        blocks.append((x, y, size))
        if len(runs) > 1:
            before, after, ex, ey = [], [], x + size, y + size
            for i, j, n in runs:
                if i < x and j < y:
                    before.append((i, j, min(n, x - i, y - j)))
                skip = max(ex - i, ey - j, 0)
                if skip < n:
                    after.append((i + skip, j + skip, n - skip))
            if before:
                parts.append(before)
            if after:
                parts.append(after)
    blocks.sort()
    out = blocks[:1]
    for i, j, n in blocks[1:]:  # neighbours are one block
        x, y, size = out[-1]
        if x + size == i and y + size == j:
            out[-1] = (x, y, size + n)
        else:
            out.append((i, j, n))
    return out


def align(a: list[bytes], b: list[bytes], i: int, j: int, steps: list[tuple[int, int]], k: int, gap: int, identity: float) -> tuple[int, int, int, int, int] | None:
    """Alignment of word lists around the match at ``a[i]``, ``b[j]``: the first and the
    end word on both sides, and the words that match.

    ``steps``: the chain's seeds as offsets from the first.  Words between seeds are
    aligned by their longest matching blocks; both ends grow by exact runs, and over
    differences that a run of ``k`` or more equal words follows within ``gap``."""
    blocks: list[tuple[int, int, int]] = []

    def between(a0: int, a1: int, b0: int, b1: int) -> None:
        if a0 < a1 and b0 < b1:
            one, two = a[a0:a1], b[b0:b1]
            if one == two:
                blocks.append((a0, b0, a1 - a0))
            elif frame := framed(one, two):
                p, s = frame
                blocks.extend(m for m in ((a0, b0, p), (a1 - s, b1 - s, s)) if m[2])
            else:
                blocks.extend((a0 + x, b0 + y, n) for x, y, n in matching_blocks(one, two))

    ea, eb = i, j
    for da, db in steps:
        x, y = i + da, j + db
        if x < ea or y < eb:  # overlaps what is aligned already
            cut = max(ea - x, eb - y)
            if cut >= k:
                continue
            x, y = x + cut, y + cut
        between(ea, x, eb, y)
        size = i + da + k - x
        if a[x : x + size] != b[y : y + size]:
            continue  # a hash that two different k-mers share
        blocks.append((x, y, size))
        ea, eb = x + size, y + size
    if not blocks:
        return None

    def grow(a_rest: list[bytes], b_rest: list[bytes]) -> list[tuple[int, int, int]]:
        """Blocks from the fronts of two lists."""
        found, p, q = [], 0, 0
        while True:
            n = ahead(a_rest, p, b_rest, q)
            if n:
                found.append((p, q, n))
                p, q = p + n, q + n
            near = gap // 4 + 1  # a run that counts starts this near, so a gram of it must be on both sides
            firsts = set(a_rest[p : p + near]).intersection(b_rest[q : q + near])
            grams_a = {tuple(a_rest[x : x + k]) for x in range(p, min(p + near, len(a_rest) - k + 1)) if a_rest[x] in firsts}
            if not grams_a or not any(b_rest[y] in firsts and tuple(b_rest[y : y + k]) in grams_a for y in range(q, min(q + near, len(b_rest) - k + 1))):
                return found
            one, two = a_rest[p : p + gap], b_rest[q : q + gap]
            if frame := framed(one, two):  # the fronts differ, so there is no prefix
                size = frame[1]
                x, y = len(one) - size, len(two) - size
            else:
                x, y, size = longest(equal_diagonals(one, two))
            if size < k or max(x, y) > gap // 4:
                return found
            p, q = p + x, q + y

    a0, b0, _ = blocks[0]
    back = grow(a[:a0][::-1], b[:b0][::-1])
    blocks = [(a0 - p - n, b0 - q - n, n) for p, q, n in reversed(back)] + blocks
    a1, b1 = blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]
    blocks += [(a1 + p, b1 + q, n) for p, q, n in grow(a[a1:], b[b1:])]
    same = sum(n for _, _, n in blocks)
    first, last = blocks[0], blocks[-1]
    a0, a1, b0, b1 = first[0], last[0] + last[2], first[1], last[1] + last[2]
    while same < identity * max(a1 - a0, b1 - b0) and len(blocks) > 1:  # the weaker end goes
        gone = blocks.pop(0) if blocks[0][2] <= blocks[-1][2] else blocks.pop()
        same -= gone[2]
        a0, a1, b0, b1 = blocks[0][0], blocks[-1][0] + blocks[-1][2], blocks[0][1], blocks[-1][1] + blocks[-1][2]
    return a0, a1, b0, b1, same


def equal_runs(a: list[bytes], b: list[bytes], matches: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Maximal runs of ``least`` or more equal words around matches: start in a, start in b, words."""
    known: dict[int, list[tuple[int, int]]] = {}
    out, back_a, back_b = [], a[::-1], b[::-1]
    for x, y in matches:
        runs = known.setdefault(x - y, [])
        for s, e in runs:
            if s <= x < e:
                break
        else:
            s, e = x - ahead(back_a, len(a) - x, back_b, len(b) - y), x + ahead(a, x, b, y)
            runs.append((s, max(e, x + 1)))
            if e - s >= least:
                out.append((s, s + y - x, e - s))
    return out


def holds(kept: list[tuple], a0: int, a1: int, b0: int, b1: int) -> bool:
    for p in kept:
        if p[0] <= a0 and a1 <= p[1] and p[2] <= b0 and b1 <= p[3]:
            return True
    return False


def merged(kept: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Passages (start, stop, words, identity) on one side of a pair, overlapping ones united."""
    out: list[tuple[int, int, int, float]] = []
    for p in sorted(kept):
        if out and p[0] < out[-1][1]:
            q = out[-1]
            out[-1] = (q[0], max(q[1], p[1]), max(q[2], p[2]), max(q[3], p[3]))
        else:
            out.append(p)
    return out


PASSAGE = T.ArrayType(row_type("side int, start long, stop long, n_words int, identity double"))


def align_udf(k: int, least: int, identity: float, reach: int, gap: int = GAP):
    """Passages on both sides of a pair from the texts around its chains, the best chain
    first; a chain whose start lies in a passage found already is part of that one.  A run
    of ``least`` equal words around a match that then lies in no passage (cut off with the
    end of a chain, or on another diagonal) is one of its own.  Overlapping passages of a
    side leave as one, as they are united in the end."""

    @pandas_udf(PASSAGE)
    def run(ta: pd.Series, oa: pd.Series, tb: pd.Series, ob: pd.Series, chained: pd.Series) -> pd.Series:
        out = []
        for x, x0, y, y0, found in zip(ta, oa, tb, ob, chained):
            wa, wb = x.encode("utf-8").lower().split(), y.encode("utf-8").lower().split()
            begin_a, begin_b = (max(0, min(c[n] for c in found) - reach) for n in ("a0", "b0"))
            kept, rows, matches = [], [], []
            for c in found:
                i, j = c["a0"] - begin_a, c["b0"] - begin_b
                steps = list(zip(c["pa"].tolist(), c["pb"].tolist()))
                matches += [(i + da, j + db) for da, db in steps]
                if holds(kept, i, i + 1, j, j + 1):
                    continue
                got = align(wa, wb, i, j, steps, k, gap, identity)
                if got is None or got[4] < least or got[4] < identity * max(got[1] - got[0], got[3] - got[2]):
                    continue
                kept.append(got)
            for i, j, n in equal_runs(wa, wb, matches, least):
                if not holds(kept, i, i + n, j, j + n):
                    kept.append((i, i + n, j, j + n, n))
            for side, text, offset, n in (0, x, x0, 0), (1, y, y0, 2):
                if kept:
                    starts, ends = spots(text)
                    spans = [(int(starts[p[n]]) + offset, int(ends[p[n + 1] - 1]) + offset, p[n + 1] - p[n], p[4] / max(p[1] - p[0], p[3] - p[2])) for p in kept]
                    rows += [(side, *p) for p in merged(spans)]
            out.append(rows)
        return pd.Series(out, dtype=object)

    return run


OCCURRENCE = ["row", "pos", "begin", "stop"]


def ends_of(each: DataFrame) -> DataFrame:
    """The first and the last occurrence of each key ``h`` that two rows hold."""
    at = F.struct(*OCCURRENCE)
    return each.groupBy("h").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n")).where("lo.row < hi.row")


def all_pairs(each: DataFrame, others: DataFrame) -> DataFrame:
    """``x, y``: occurrences of one key ``h`` in two rows."""
    one = lambda df, c: df.select("h", F.struct(*OCCURRENCE).alias(c))
    return one(each, "x").join(one(others, "y"), "h").where("x.row <> y.row").select("x", "y")


def with_ends(held: DataFrame) -> DataFrame:
    """``x, y``: occurrences with the first and the last one of their key."""
    return held.select(F.struct(*OCCURRENCE).alias("x"), F.explode(F.array("lo", "hi")).alias("y")).where("x.row <> y.row")


def matches_of(met: DataFrame) -> DataFrame:
    """``a, b, matches`` of pairs of rows from occurrences ``x`` and ``y`` in either order."""
    swapped = F.expr("x.row > y.row")
    met = met.select(F.when(swapped, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(swapped, F.col("x")).otherwise(F.col("y")).alias("y"))
    m = [F.col(f"{side}.{c}").alias(n) for side, to in (("x", "a"), ("y", "b")) for c, n in (("pos", f"p{to}"), ("begin", f"begin_{to}"), ("stop", f"stop_{to}"))]
    plain = met.select(F.col("x.row").alias("a"), F.col("y.row").alias("b"), *m).distinct()  # before any list: a match comes once for each key near it
    return plain.groupBy("a", "b").agg(F.collect_list(F.struct(*plain.columns[2:])).alias("matches"))


def shared_seeds(rows: DataFrame, member: DataFrame) -> DataFrame:
    """Occurrences ``h, row, pos, begin, stop`` of the seeds that two different texts hold, in the first rows of equal texts.

    ``rows``: ``row`` and ``seeds``; ``member``: ``row`` and ``first``, the first row of an equal text."""
    # staged, so that Spark sees where copies are few enough not to shuffle the seeds for them
    copies = staged(member.where("row <> first").select("row"), "substring-copies")
    each = rows.join(copies, "row", "left_anti").select("row", F.explode("seeds").alias("s")).select("row", "s.*")
    shared = staged(each.groupBy("h").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("h"), "substring-seeds")
    return staged(each.join(shared.hint("merge"), "h"), "substring-each")


def matched_pairs(each: DataFrame, member: DataFrame, texts: DataFrame, k: int, window: int, least: int, reach: int, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """``(a, b, matches)`` of the first rows of equal texts that share seeds, and the ``wide`` keys of :func:`left_pairs`.

    ``each``: occurrences of seeds (:func:`shared_seeds`)."""
    firsts = member.where("row = first")
    # staged, so that the joins shuffle plain rows on both sides and split a seed that very many rows hold
    ends = staged(ends_of(each), "substring-ends")
    twice = ends.where("n = 2").select(F.col("lo").alias("x"), F.col("hi").alias("y"))
    held = staged(each.join(ends.where("n > 2").hint("merge"), "h"), "substring-held")
    few, many = held.where(F.col("n") <= cap), held.where(F.col("n") > cap)
    found = twice.unionByName(all_pairs(few, few).where("x.row < y.row"))
    # where a text repeats itself, the keys below stand for the first place; the others meet the ends of the seed
    later = many.withColumn("before", F.min("pos").over(Window.partitionBy("row", "h"))).where("pos > before").drop("before")
    found = found.unionByName(with_ends(later))
    common = many.groupBy("row").agg(F.collect_set("h").alias("common"))
    common = common.join(firsts.select("row", "digest", F.col("least_id").alias("id")), "row")
    met = common.join(texts, (common["digest"] == texts["own"]) & common["id"].eqNullSafe(texts["doc_id"]))
    shared = staged(met.select("row", shared_udf(k, window, least, reach)("text", "common").alias("s")).select("row", "s.*"), "substring-shared")
    runs = shared.select("row", F.explode("runs").alias("s")).select("row", "s.*")
    whole = with_ends(runs.join(staged(ends_of(runs), "substring-run-ends").hint("merge"), "h"))
    near = shared.select("row", F.explode("near").alias("s")).select("row", "s.*")
    sizes = near.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("h", "n")
    # at its place in the text a key has the context of its seed
    near = near.join(staged(sizes, "substring-near-sizes").hint("merge"), "h").join(many.select(F.col("h").alias("seed"), *OCCURRENCE).distinct(), ["row", "pos"])
    near = staged(near, "substring-near")
    rare = near.where(F.col("n") <= cap)
    wide = near.where(F.col("n") > cap)
    # texts that share no more than fewer than `least` words with more than `cap` others need a rare key
    first, last = F.least("pos", "at"), F.greatest("pos", "at")
    spans = wide.groupBy("row", "pos").agg(F.min(first).alias("i"), F.max(last).alias("j"))
    wide = staged(wide.join(spans.where(F.col("j") + k - F.col("i") >= least).select("row", "pos"), ["row", "pos"]), "substring-wide")
    found = found.unionByName(whole).unionByName(all_pairs(rare, rare).where("x.row < y.row"))
    long = wide.where(F.abs(F.col("at") - F.col("pos")) + k >= least)  # ends that may hold a passage
    found = found.unionByName(with_ends(long.join(staged(ends_of(long), "substring-wide-ends").hint("merge"), "h")))
    return matches_of(found), wide


def left_meetings(wide: DataFrame, found: DataFrame) -> DataFrame:
    """``x, y``: occurrences of seeds with ``wide`` keys that lie in no passages found, and all others that share such a key.

    A key holds its seed, so two occurrences meet once, by the seed, however many keys they share."""
    covered = islands(found).groupBy("first", "island").agg(F.min("start").alias("since"), F.max("stop").alias("until"))
    inside = (wide["row"] == covered["first"]) & (covered["since"] <= wide["start"]) & (covered["until"] >= wide["end"])
    listed = lambda df: df.groupBy("seed", *OCCURRENCE).agg(F.collect_list("h").alias("keys"))
    one = lambda df, c, keys: df.select("seed", F.struct(*OCCURRENCE).alias(c), F.col("keys").alias(keys))
    lost = staged(listed(wide.join(covered, inside, "left_anti")), "substring-lost")
    holders = listed(wide.join(lost.select("seed").distinct(), "seed", "left_semi"))
    return one(lost, "x", "lost").join(one(holders, "y", "held"), "seed").where("x.row <> y.row and arrays_overlap(lost, held)").select("x", "y")


def left_pairs(wide: DataFrame, found: DataFrame) -> DataFrame:
    """``(a, b, matches)`` of the ``wide`` keys that lie in no passages found, with all texts that share them."""
    return matches_of(left_meetings(wide, found))


def texts_of(each: DataFrame, member: DataFrame, base: DataFrame) -> DataFrame:
    """The texts of the rows in ``each``; a class by its digest and its smallest id, so that copies do not come along."""
    asked = member.join(each.select("row").distinct(), "row", "left_semi").select("digest", F.col("least_id").alias("id"))
    met = base.join(asked, (base["own"] == asked["digest"]) & base["doc_id"].eqNullSafe(asked["id"]), "left_semi")
    return staged(met, "substring-texts")


def snippet(pairs: DataFrame, texts: DataFrame, side: str) -> DataFrame:
    """``pairs`` with ``text_x`` and ``offset_x`` (or ``_y``): the text around all chains on that side, in whole words."""
    met = pairs.join(texts, (pairs[f"digest_{side}"] == texts["own"]) & pairs[f"id_{side}"].eqNullSafe(texts["doc_id"]))
    text = F.substring("text", F.col(f"i_{side}") + 1, F.col(f"j_{side}") - F.col(f"i_{side}"))
    gone = [f"{c}_{side}" for c in ("digest", "id", "i", "j")]
    return met.select(*[c for c in pairs.columns if c not in gone], text.alias(f"text_{side}"), F.col(f"i_{side}").alias(f"offset_{side}"))


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW, least: int = LEAST, identity: float = IDENTITY, reach: int = REACH
) -> DataFrame:
    """One row for each maximal passage of a document (see the module's text)."""
    if window + k - 1 > least:
        raise ValueError("a run of `least` words must hold a seed")
    base = doc_columns(docs, id_col, text_col).withColumn("own", F.unhex(F.sha2("text", 256)))
    rows = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("own").alias("digest"), seeds_udf(k, window, reach)("text").alias("s"))
    rows = staged(rows.select("row", "doc_id", "digest", "s.*"), "substring-rows")
    classes = rows.groupBy("digest").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("least_id"), F.max("doc_id").alias("most_id"))
    member = staged(rows.select("row", "doc_id", "n_words", "n_chars", "digest").join(classes, "digest"), "substring-members")
    each = shared_seeds(rows, member)
    texts = texts_of(each, member, base)
    pairs, wide = matched_pairs(each, member, texts, k, window, least, reach)
    found = staged(passages_of(pairs, member, texts, k, least, identity, reach), "substring-passages")
    left = staged(left_pairs(wide, found), "substring-left")
    if not left.isEmpty():
        found = found.unionByName(staged(passages_of(left, member, texts, k, least, identity, reach), "substring-passages"))
    return _result(member, found, least)


def passages_of(pairs: DataFrame, member: DataFrame, texts: DataFrame, k: int, least: int, identity: float, reach: int) -> DataFrame:
    """Passages of aligned pairs, on both sides: ``first, partner, start, stop, n_words, identity``."""
    chained = staged(pairs.select("a", "b", chain_matches("matches").alias("c")), "substring-chains")
    asked = {s: [F.col(s), F.array_min(f"c.begin_{s}"), F.array_max(f"c.stop_{s}")] for s in "ab"}
    flip = (asked["a"][2] - asked["a"][1]) > (asked["b"][2] - asked["b"][1])
    # only the shorter text of a pair (x) is shuffled, to where the other one (y) lies
    sides = [F.when(flip, q).otherwise(p).alias(f"{c}_{side}") for side, of, to in (("x", "a", "b"), ("y", "b", "a")) for c, p, q in zip(("row", "i", "j"), asked[of], asked[to])]
    chained = chained.select("a", "b", "c", flip.alias("flip"), *sides)
    for side in "xy":
        names = member.select(F.col("row").alias(f"row_{side}"), F.col("digest").alias(f"digest_{side}"), F.col("least_id").alias(f"id_{side}"))
        chained = chained.join(names, f"row_{side}").drop(f"row_{side}")
    both = snippet(snippet(chained, texts, "x"), texts, "y")
    args = [F.when(F.col("flip"), F.col(f"{c}_{q}")).otherwise(F.col(f"{c}_{p}")) for p, q in ("xy", "yx") for c in ("text", "offset")]
    found = align_udf(k, least, identity, reach)(*args, "c")
    return both.select("a", "b", F.explode(found).alias("p")).select(
        F.when(F.col("p.side") == 0, F.col("a")).otherwise(F.col("b")).alias("first"), F.when(F.col("p.side") == 0, F.col("b")).otherwise(F.col("a")).alias("partner"), "p.*"
    )


def islands(found: DataFrame) -> DataFrame:
    """Passages of classes, those that overlap under one ``island``."""
    spans = found.groupBy("first", "start", "stop").agg(F.max("n_words").alias("n_words"), F.max("identity").alias("identity"), F.min("partner").alias("partner"))
    ordered = Window.partitionBy("first").orderBy("start", "stop")
    before = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    return spans.withColumn("island", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))


def _result(member: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """Passages of classes, united where they overlap, for every member; whole texts of copies."""
    spans = islands(found)
    united = spans.groupBy("first", "island").agg(
        F.min("start").alias("start"), F.max("stop").alias("end"), F.max("n_words").alias("n_words"), F.max("identity").alias("identity"), F.min("partner").alias("partner")
    )
    count = found.select("first", "partner").distinct().groupBy("first").agg(F.count(F.lit(1)).alias("n_partners"))
    names = member.where("row = first").select(F.col("first").alias("partner"), F.col("least_id").alias("partner_id"))
    united = united.join(names, "partner").join(count, "first").drop("partner", "island")
    copies = (F.col("size") > 1) & (F.col("n_words") >= least)
    whole = member.where(copies).select(
        "doc_id", F.lit(0).cast("long").alias("start"), F.col("n_chars").alias("end"), "n_words", F.lit(1.0).alias("identity"),
        F.when(F.col("doc_id").eqNullSafe(F.col("least_id")), F.col("most_id")).otherwise(F.col("least_id")).alias("partner_id"), (F.col("size") - 1).alias("n_partners"),
    )
    parts = member.where(~copies).select("doc_id", "first").join(united, "first")
    columns = ["doc_id", "start", "end", "n_words", "identity", "partner_id", "n_partners"]
    return parts.select(*columns).unionByName(whole.select(*columns))
