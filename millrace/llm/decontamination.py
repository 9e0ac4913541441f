"""Benchmark decontamination by q-gram lemma filtering.

If a stretch of a document comes from a benchmark text with at most e edits, these destroy at most q e of any set of its
q-grams; of a set of q e + s at least s are shared, and their diagonals (document place less item place) lie within
e + 1 of each other. Shared q-grams are therefore counted in cells of e + 1 diagonals; two neighbouring cells together
are one of the overlapping bands, and any band with fewer than s, or with fewer than s different places of the item, is
out. What is left is verified by alignment within the band. Of places of an item that overlap, the one with the fewest
edits stays, of equal ones the first, then the shortest; places apart all stay.

The benchmark is indexed in blocks of bounded size, which tasks write to the shared folder and read from there: neither
the driver nor a plan ever holds it. Documents are read once, each step of them against every block.
"""

from __future__ import annotations

import functools
import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import EMPTIED, STEP_BYTES, cut, map_steps, put_file, read_whole, task_name, text_of, uncollected, work_path

Q = 6
#: Edits allowed, as a share of the benchmark text.
EDITS = 0.125
#: Each item is looked for by its rarest q-grams: those that e edits can destroy (q e) and so many more.
SPARE = 24
#: Benchmark characters of a block; a task holds one index at a time, and larger steps of documents where there are several.
BLOCK_CHARS = 2_000_000
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _spaces() -> np.ndarray:
    t = np.arange(0x3001, dtype=np.uint32)
    t[[c for c in range(0x3001) if chr(c).isspace()]] = 32
    return t


SPACES = _spaces()


def plain(text: str) -> str:
    """Lower case, place for place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(x := c.lower()) > 1 else x for c in text)


def points(text: str) -> np.ndarray:
    """The code points, every white space a space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(codes < len(SPACES), SPACES[np.minimum(codes, len(SPACES) - 1)], codes)


def qgrams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit number for the q-gram at each place."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(Q):
        h = h * PRIME + codes[k : n + k].astype(np.uint64) + np.uint64(1)
    return h ^ h >> np.uint64(31)


def budget(m: int) -> int:
    """Edits allowed for a text of m characters: as many as leave the bound at 1 or more."""
    return max(0, min(int(m * EDITS), (m - Q) // Q))


class Items:
    """The index of a block of benchmark texts: rows of (id, text, how often the row stands in the table)."""

    def __init__(self, rows: tuple[tuple[int | None, str, int], ...]):
        texts = [(i, plain(t), times) for i, t, times in rows]
        self.short = [(i, points(t).tobytes(), len(t), times) for i, t, times in texts if 0 < len(t) < Q]  # found as they stand
        self.rows = [(i, points(t)) for i, t, _ in texts if len(t) >= Q]
        self.times = [times for _, t, times in texts if len(t) >= Q]
        self.size = np.array([len(c) for _, c in self.rows], np.int64)
        self.edits = np.array([budget(int(m)) for m in self.size], np.int64)
        self.step = self.edits + 1
        grams = [qgrams(c) for _, c in self.rows] or [np.empty(0, np.uint64)]
        names, where, often = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        ends = np.cumsum([len(g) for g in grams])
        use = [np.sort(np.argsort(often[where[b - len(g) : b]], kind="stable")[: Q * int(e) + SPARE]) for g, b, e in zip(grams, ends, self.edits)]
        self.least = np.array([len(u) for u in use], np.int64)[: len(self.rows)] - Q * self.edits
        chosen = np.concatenate([g[u] for g, u in zip(grams, use)]) if use else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(use)), [len(u) for u in use])
        place = np.concatenate(use) if use else np.empty(0, np.int64)
        order = np.argsort(chosen, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, self.begin, self.count = np.unique(chosen[order], return_index=True, return_counts=True)
        self.at = np.full(1 << 22, -1, np.int32)  # of a gram by its slot; the few that share one are searched for
        self.at[self.slot(self.gram)] = np.arange(len(self.gram))

    @staticmethod
    def slot(grams: np.ndarray) -> np.ndarray:
        return (grams * PRIME >> np.uint64(42)).astype(np.int64)

    def known(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of the grams that the index has."""
        k = self.at[self.slot(grams)]
        at = np.flatnonzero(k >= 0)
        k, g = k[at], grams[at]
        other = np.flatnonzero(self.gram[k] != g)
        k[other] = np.minimum(np.searchsorted(self.gram, g[other]), len(self.gram) - 1)
        same = self.gram[k] == g
        return at[same], k[same]

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(item, cell): the bands that begin with this cell meet the bound, by grams and then by different places of the item."""
        grams = qgrams(codes)
        if not len(grams) or not len(self.gram):
            return []
        at, k = self.known(grams)
        n = self.count[k]
        total = int(n.sum())
        if total < self.least.min():
            return []
        entry = np.repeat(self.begin[k] - np.cumsum(n) + n, n) + np.arange(total)
        item, place, at = self.item[entry], self.place[entry], np.repeat(at, n)
        near = (np.bincount(item, minlength=len(self.size)) >= self.least)[item]  # items with enough of their grams anywhere
        if not near.any():
            return []
        item, place, at = item[near], place[near], at[near]
        total = len(item)
        cells = (len(codes) + self.size) // self.step + 2
        first = np.cumsum(cells) - cells
        key = first[item] + (at - place + self.size[item]) // self.step[item]
        if int(cells.sum()) > 8 * total:  # few grams in many cells: number the cells that have any
            filled, short = np.unique(np.concatenate([key, key - 1]), return_inverse=True)
            key, numbers = short[:total], filled
        else:
            numbers = np.arange(int(cells.sum()) + 1)
        counts = np.bincount(key, minlength=len(numbers) + 1)
        follows = np.append(numbers[1:] == numbers[:-1] + 1, False)
        both = counts[: len(numbers)] + np.where(follows, counts[1 : len(numbers) + 1], 0)
        owner = np.searchsorted(first, numbers[(used := np.flatnonzero(both >= self.least.min()))], side="right") - 1
        flagged = np.zeros(len(numbers) + 1, bool)
        flagged[used[both[used] >= self.least[owner]]] = True
        if not flagged.any():
            return []
        here, before = flagged[key], flagged[key - 1] & (key > 0)
        before &= np.append(follows, False)[key - 1]
        band, spot = np.concatenate([key[here], key[before] - 1]), np.concatenate([place[here], place[before]])
        width = int(self.size.max())
        different = np.bincount(np.unique(band * width + spot) // width, minlength=len(numbers))
        used = np.flatnonzero(different)
        owner = np.searchsorted(first, numbers[used], side="right") - 1
        good = different[used] >= self.least[owner]
        return [(int(o), int(numbers[u] - first[o])) for o, u in zip(owner[good], used[good])]

    def found_in(self, text: str) -> bool:
        """Whether a text holds any item."""
        codes = points(plain(text))
        raw = codes.tobytes() if self.short else b""
        for _, t, _, _ in self.short:
            at = raw.find(t)
            while at >= 0 and at % 4:
                at = raw.find(t, at + 1)
            if at >= 0:
                return True
        for item, cell in self.candidates(codes):
            e, low = int(self.edits[item]), cell * int(self.step[item]) - int(self.size[item])
            if banded(self.rows[item][1], codes, low - e, low + 2 * int(self.step[item]) - 1 + e, e):
                return True
        return False

    def matches(self, text: str) -> list[tuple[int | None, int, int, int, int]]:
        """(item id, start, end, edits, characters of the item) of every place of each item, as often as the item stands in its table."""
        codes = points(plain(text))
        raw = codes.tobytes() if self.short else b""
        found = []
        for i, t, n, times in self.short:
            at = raw.find(t)
            while at >= 0:
                if at % 4 == 0:
                    found += [(i, at // 4, at // 4 + n, 0, n)] * times
                at = raw.find(t, at + (4 * n if at % 4 == 0 else 1))
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for item, cell in self.candidates(codes):
            m, e, step = int(self.size[item]), int(self.edits[item]), int(self.step[item])
            low = cell * step - m
            high = low + 2 * step - 1
            # all that this band can give overlaps a place without edits
            if any(d == 0 and a - m + e < low - e and high + e < b for d, a, b in hits.get(item, ())):
                continue
            hit = banded(self.rows[item][1], codes, low - e, high + e, e)
            if hit:
                hits.setdefault(item, []).append(hit)
        for o in sorted(hits):
            places = [(self.rows[o][0], start, end, d, int(self.size[o])) for d, start, end in apart(hits[o])]
            found += [x for x in places for _ in range(self.times[o])]
        return found


def apart(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, start, end) those that overlap no better one, by place."""
    kept: list[tuple[int, int, int]] = []
    for d, a, b in sorted(set(hits)):
        if all(b <= x or y <= a for _, x, y in kept):
            kept.append((d, a, b))
    return sorted(kept, key=lambda h: h[1])


FAR = 1 << 28


def banded(item: np.ndarray, doc: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of the whole item with a stretch of doc on diagonals low to high; None beyond `most` edits."""
    m, width = len(item), high - low + 1
    place = low + np.arange(width)  # of the document, before row 0
    inside = (place >= 0) & (place <= len(doc))
    cost = np.where(inside, 0, FAR)
    start = place.copy()
    padded = np.zeros(m + width, np.int64) - 1
    a, b = max(low, 0), min(low + m + width, len(doc))
    if a < b:
        padded[a - low : b - low] = doc[a:b]
    steps = np.arange(width)
    for i in range(1, m + 1):
        sub = cost + (padded[i - 1 : i - 1 + width] != item[i - 1])
        gone = np.append(cost[1:], FAR) + 1
        new = np.minimum(sub, gone)
        origin = np.where(sub <= gone, start, np.append(start[1:], 0))
        j = low + i + steps
        new = np.where((j >= 0) & (j <= len(doc)), new, FAR)
        slope = new - steps
        least = np.minimum.accumulate(slope)
        came = np.maximum.accumulate(np.where(slope == least, steps, 0))
        cost, start = np.minimum(least + steps, FAR), origin[came]
        if cost.min() > most:
            return None
    k = int(np.argmin(cost))
    return (int(cost[k]), max(0, int(start[k])), low + m + k) if cost[k] <= most else None


@functools.lru_cache(2)
def index(path: str) -> Items:
    return Items(tuple(map(tuple, json.loads(read_whole(path)))))


EMPTIED[__name__] = index.cache_clear


def index_files(spark: SparkSession, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[str]:
    """Writes the benchmark to the shared folder in blocks of bounded size; returns their paths. Null and empty texts match nothing;
    repeated rows are counted first; a text alone over the bound is a block."""
    rows = text_of(benchmark, id_col, text_col).where(F.length(text_col) > 0).groupBy(F.col(id_col).alias("id"), F.col(text_col).alias("text")).agg(F.count("*").alias("times"))
    rows = cut(spark, rows, "benchmark")
    chars = rows.agg(F.sum(F.length("text").cast("long")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(2 * chars / BLOCK_CHARS)) if chars > BLOCK_CHARS else 1
    out = work_path(spark, "benchmark-blocks")

    def write(key, block):
        path = f"{out}/{task_name()}-{key[0].as_py():06d}.json"
        given = sorted(zip(*(block.column(c).to_pylist() for c in ("id", "text", "times"))), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        put_file(path, json.dumps(given).encode())
        return pa.table({"path": pa.array([path], pa.string())})

    found = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n))).groupBy("block").applyInArrow(write, "path string")
    return sorted(r["path"] for r in cut(spark, found, "benchmark-paths").collect())


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each place of a benchmark text in a document: id, item_id, start, end (code points), edits, similarity.

    A null text is an empty one. A null id stays null. Repeated rows of either table give repeated rows. Other columns
    are not read, whatever their names. An empty benchmark or table gives an empty result.
    """
    schema = f"`{id_col}` long, item_id long, start long, end long, edits long, similarity double"
    files = index_files(spark, benchmark)

    def make(part):
        ids, texts = part.column(id_col).to_pylist(), part.column(text_col).to_pylist()
        rows = []
        for path in files:
            items = index(path)
            rows += [(doc_id, i, a, b, d, round(1 - d / m, 6)) for doc_id, t in zip(ids, texts) for i, a, b, d, m in items.matches(t)]
        return list(zip(*rows)) or [[]] * 6

    return map_steps(text_of(docs, id_col, text_col), text_col, make, schema, step_bytes(files))


def step_bytes(files: list[str]) -> int:
    return STEP_BYTES if len(files) < 2 else 8 * STEP_BYTES


def leaks(spark: SparkSession, benchmark: DataFrame, text_col: str = "text"):
    """Column: whether a text holds any benchmark text; null and empty texts do not."""
    files = index_files(spark, benchmark)

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        given = [t or "" for t in texts.to_pylist()]
        found = [False] * len(given)
        with uncollected():
            for path in files:
                items = index(path)
                found = [f or items.found_in(t) for f, t in zip(found, given)]
        return pa.array(found, pa.bool_())

    return run(F.col(text_col))
