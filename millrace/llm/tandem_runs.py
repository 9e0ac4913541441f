"""Periodic runs of words by the tandem repeats of Gusfield and Stoye.

1. The words of a text are cut into Lempel-Ziv blocks. Extensions from the blocks' borders give squares (stretches that
   are some root twice) that cover, leftmost, every square there is: all others are reached by turning one of these.
2. Each of them ends at a point of the suffix tree.
3. From there the walk goes on: a suffix link drops the first word, and if the tree goes on with that word the turned
   square stands in the text too. A walk ends where the tree doesn't go on, or at a point that is known. So the
   vocabulary of squares is complete.
4. The leaves below a point are all places of its square. Squares of one root length at consecutive places are one run.

Only squares whose root is no repetition itself are carried on from step 2: turning keeps that, and a run is named by its
least period, so the others add nothing.

Before that, words that cannot be in a run are put aside. In a run of period q and length max(6, 4q) or more each five
consecutive words occur again at a distance of at most q, a quarter of its length. What is left are stretches of words,
which the tree is made of, those of a step's texts together, with a mark of its own after each.

One text of w such words takes some w log w numbers, about 1 KB a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import map_steps, text_of

#: The least length of a run in words, and in periods.
LEAST, TIMES = 6, 4
GRAM = 5
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


class Ranks:
    """ranks[j][i] numbers the different stretches codes[i : i + 2**j] in their order. The last code occurs once."""

    def __init__(self, codes: np.ndarray, longest: int):
        self.n, ranks = len(codes), [np.unique(codes, return_inverse=True)[1].astype(np.int32)]
        while 1 << len(ranks) <= 2 * longest:
            old, half = ranks[-1].astype(np.int64), 1 << len(ranks) - 1
            after = np.zeros(self.n, np.int64)
            after[: max(0, self.n - half)] = old[half:] + 1
            ranks.append(np.unique(old * (self.n + 1) + after, return_inverse=True)[1].astype(np.int32))
        self.ranks = ranks

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes from a and from b on are the same; a and b differ."""
        at, other = a.copy(), b.copy()
        for j in range(len(self.ranks) - 1, -1, -1):
            step = (self.ranks[j][at] == self.ranks[j][other]).astype(np.int64) << j
            at += step
            other += step
        return at - a

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes up to a and up to b are the same; -1 is before the first."""
        at, other = a.copy(), b.copy()
        for j in range(len(self.ranks) - 1, -1, -1):
            x, y = at - (1 << j) + 1, other - (1 << j) + 1
            inside = (x >= 0) & (y >= 0)
            same = inside & (self.ranks[j][np.maximum(x, 0)] == self.ranks[j][np.maximum(y, 0)])
            at -= same.astype(np.int64) << j
            other -= same.astype(np.int64) << j
        return a - at


def block_starts(ranks: Ranks, order: np.ndarray) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks, and the end: a block is the longest stretch that also begins before it, or one new code."""
    n = ranks.n
    places = order.tolist()
    below, above, stack = [-1] * n, [-1] * n, []
    for p in places:  # the nearest in order, on either side, among those that begin earlier
        while stack and stack[-1] > p:
            above[stack.pop()] = p
        below[p] = stack[-1] if stack else -1
        stack.append(p)
    longest = np.zeros(n, np.int64)
    for near in (np.array(below), np.array(above)):
        have = np.flatnonzero(near >= 0)
        longest[have] = np.maximum(longest[have], ranks.forward(have, near[have]))
    sizes, starts, at = longest.tolist(), [], 0
    while at < n:
        starts.append(at)
        at += max(1, sizes[at])
    return np.array([*starts, n])


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of sizes, its index so often, and the numbers from 1 to it."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(1, len(which) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def covering_squares(ranks: Ranks, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start and root length of squares that cover all others from the left."""
    found = []
    size = np.diff(starts)
    # centres in a block, right ends beyond it
    which, k = spread(size[:-1])
    end = starts[1:][which]
    q = end - k
    ahead, back = ranks.forward(end, q), ranks.backward(end - 1, q - 1)
    good = (ahead + back >= k) & (ahead > 0)
    found.append((np.maximum(q - back, q - k + 1)[good], k[good]))
    # squares that begin before a block, with the centre in it
    which, k = spread(size + np.append(size[1:], 0))
    begin, end = starts[:-1][which], starts[1:][which]
    q = begin + k
    inside = (begin > 0) & (q < ranks.n)
    begin, end, q, k = begin[inside], end[inside], q[inside], k[inside]
    ahead, back = ranks.forward(begin, q), ranks.backward(begin - 1, q - 1)
    start = np.maximum(begin - back, begin - k + 1)
    good = (ahead + back >= k) & (ahead > 0) & (start + k <= end) & (back > 0)
    found.append((start[good], k[good]))
    return tuple(np.concatenate(x) for x in zip(*found))


def primitive(ranks: Ranks, start: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Whether the root of a square is no repetition itself: no shift of it by its length over a prime number gives it again."""
    most = int(root.max(initial=1))
    least_factor = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if least_factor[p] == p:
            multiples = least_factor[p * p :: p]
            multiples[multiples == np.arange(p * p, most + 1, p)] = p
    good, rest = np.ones(len(root), bool), root.copy()
    while (todo := np.flatnonzero(rest > 1)).size:
        p = least_factor[rest[todo]]
        shift = root[todo] // p
        good[todo] &= ranks.forward(start[todo], start[todo] + shift) < 2 * root[todo] - shift
        rest[todo] //= p
    return good


class Tree:
    """The suffix tree over a suffix array: the leaf of order[r] is node r, inner nodes follow, the first is the root."""

    def __init__(self, codes: np.ndarray, ranks: Ranks, order: np.ndarray):
        n = ranks.n
        common = [0, *ranks.forward(order[1:], order[:-1]).tolist()]
        depth, parent = [*(n - order).tolist(), 0], [n] * (n + 1)
        low, high, stack = [*range(n), 0], [*range(n), n - 1], [n]
        for r in range(1, n):
            last, shared = r - 1, common[r]
            while depth[stack[-1]] > shared:
                parent[last] = last = stack.pop()
                high[last] = r - 1
            if depth[stack[-1]] < shared:
                stack.append(len(depth))
                depth.append(shared)
                parent.append(n)
                low.append(low[last])
                high.append(n - 1)
            parent[last] = stack[-1]
        last = n - 1
        while stack:
            parent[last] = stack[-1]
            last = stack.pop()
            high[last] = n - 1
        parent[n] = n
        self.root, self.order = n, order
        self.depth, self.parent, self.low, self.high = map(np.array, (depth, parent, low, high))
        self.leaf = np.empty(n, np.int64)
        self.leaf[order] = np.arange(n)
        self.ups = [self.parent]
        while (self.ups[-1] != n).any():
            self.ups.append(self.ups[-1][self.ups[-1]])
        self.codes, self.kinds = codes, int(codes.max()) + 1
        nodes = np.flatnonzero(np.arange(len(depth)) != n)
        first = codes[order[self.low[nodes]] + self.depth[self.parent[nodes]]]
        self.child = dict(zip((self.parent[nodes] * self.kinds + first).tolist(), nodes.tolist()))
        inner = np.arange(n, len(depth))
        self.link = np.full(len(depth), n)
        linked = inner[self.depth[inner] > 1]
        self.link[linked] = self.point(order[self.low[linked]] + 1, self.depth[linked] - 1)

    def point(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The node whose edge from above codes[at : at + size] ends on."""
        node = self.leaf[at]
        for up in reversed(self.ups):
            above = up[node]
            node = np.where(self.depth[above] >= size, above, node)
        return node

    def vocabulary(self, start: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node and root length of all squares that are reached by turning the given ones."""
        depth, parent, link = self.depth.tolist(), self.parent.tolist(), self.link.tolist()
        first, codes, child, kinds = self.order[self.low].tolist(), self.codes.tolist(), self.child, self.kinds
        known = set(zip(self.point(start, 2 * root).tolist(), root.tolist()))
        for node, q in list(known):
            size = 2 * q - 1
            while True:
                at = first[node]
                word = codes[at]
                x = link[parent[node]]  # the root's link is the root: all is walked down then
                while depth[x] < size:
                    x = child[x * kinds + codes[at + 1 + depth[x]]]
                if depth[x] == size:
                    x = child.get(x * kinds + word)
                elif codes[first[x] + size] != word:
                    x = None
                if x is None or (x, q) in known:
                    break
                known.add((x, q))
                node = x
        return tuple(np.array(x, np.int64) for x in zip(*known)) if known else (np.empty(0, np.int64),) * 2

    def places(self, node: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Root length and place of every occurrence of the squares that end on the edges of these nodes."""
        which, k = spread(self.high[node] - self.low[node] + 1)
        return root[which], self.order[self.low[node][which] + k - 1]


def all_runs(codes: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of the runs in codes by start and period; codes ends with a number that it has once.
    longest: an upper bound for the length of a run."""
    if len(codes) < 3:
        return np.empty((0, 3), np.int64)
    codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    ranks = Ranks(codes, longest)
    order = np.argsort(ranks.ranks[-1], kind="stable")
    start, root = covering_squares(ranks, block_starts(ranks, order))
    good = primitive(ranks, start, root)
    tree = Tree(codes, ranks, order)
    q, at = tree.places(*tree.vocabulary(start[good], root[good]))
    by = np.lexsort((at, q))
    q, at = q[by], at[by]
    new = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (at[1:] != at[:-1] + 1)])[: len(q)])
    last = np.append(new[1:], len(q))[: len(new)] - 1
    rows = np.stack([at[new], at[last] - at[new] + 2 * q[new], q[new]], axis=1) if len(new) else np.empty((0, 3), np.int64)
    rows = rows[rows[:, 1] >= np.maximum(least, times * rows[:, 2])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def live_stretches(texts: Sequence[np.ndarray]) -> list[tuple[int, int, int]]:
    """(text, start, end) of the stretches of words that can hold runs of LEAST words and TIMES periods or more."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), sizes)
    n = len(codes) - GRAM + 1
    if n < 2:
        return []
    key = (of[:n].astype(np.uint64) + np.uint64(1)) * MIX[GRAM]
    for k in range(GRAM):
        key += codes[k : n + k] * MIX[k]
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    gap = np.where(key[order][1:] == key[order][:-1], np.diff(order), len(codes))
    distance = np.full(n, len(codes))
    distance[order[1:]] = gap
    distance[order[:-1]] = np.minimum(distance[order[:-1]], gap)
    live = (distance < len(codes)) & (of[:n] == of[GRAM - 1 :])
    while True:
        edge = np.diff(np.concatenate([[0], live.astype(np.int8), [0]]))
        # a text's last words and the next one's first are no gram of either, so no stretch goes over
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        allowed = np.zeros(n, np.int64)
        allowed[live] = np.repeat((end - begin + GRAM - 1) // TIMES, end - begin)
        near = live & (distance <= allowed)
        if (near == live).all():
            break
        live = near
    offset = np.cumsum(sizes) - sizes
    return [(t := int(of[b]), int(b - offset[t]), int(e + GRAM - 1 - offset[t])) for b, e in zip(begin, end) if e - b >= LEAST - GRAM + 1]


def text_runs(texts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For every text, numbers of its words, the rows (start, length, period) of its runs by start and period."""
    stretches = live_stretches(texts)
    out = [np.empty((0, 3), np.int64)] * len(texts)
    if not stretches:
        return out
    # words of different texts get different numbers, and each stretch a mark of its own at its end
    parts, offset = [], 0
    for t, a, b in stretches:
        part = texts[t][a:b]
        parts += [offset + part, np.array([offset + int(part.max()) + 1])]
        offset += int(part.max()) + 2
    begins = np.cumsum([0, *(b - a + 1 for _, a, b in stretches)])
    rows = all_runs(np.concatenate(parts), max(b - a for _, a, b in stretches))
    where = np.searchsorted(begins, rows[:, 0], "right") - 1
    for k, (t, a, _) in enumerate(stretches):
        own = rows[where == k] if len(stretches) < 64 else rows[np.searchsorted(where, k) : np.searchsorted(where, k + 1)]
        if len(own):
            out[t] = np.concatenate([out[t], own + [a - begins[k], 0, 0]])
    return out


def words_of(doc_id: int | None, text: str) -> list[bytes]:
    """The words, those of every tenth document (by the crc32 of its id) from some place on replaced by a repetition of the first few."""
    words = text.encode("utf-8", "surrogatepass").split()  # at the six characters of ASCII that the contract names
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]
    return words


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without what any run holds after its first period."""
    if len(runs):
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
        np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0)]
    return b" ".join(words)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """id, runs (array of start, length, period, by start and period), collapsed (the text's words without the repetitions,
    joined by spaces) for every row of docs.

    plant: first replace words of every tenth document as words_of() does. A null text is an empty one and has no words; a
    null id stays null and is never planted in; repeated rows give repeated results; other columns are not read, whatever
    their names; an empty table gives an empty result. Whole texts are read.
    """

    def make(part):
        ids, texts = part.column(id_col).to_pylist(), part.column(text_col).to_pylist()
        words = [words_of(i if plant else None, t) for i, t in zip(ids, texts)]
        codes = []
        for w in words:
            number = {}
            codes.append(np.fromiter(map(number.setdefault, w, count()), np.int64, len(w)))
        runs = text_runs(codes)
        listed = [[dict(zip(("start", "length", "period"), r)) for r in x.tolist()] for x in runs]
        return part.column(id_col), listed, [collapsed(w, r) for w, r in zip(words, runs)]

    schema = f"`{id_col}` long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return map_steps(text_of(docs, id_col, text_col), text_col, make, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The number of runs, the longest one, and digests of all runs and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    rows = found.select("*", longest.alias("longest"))
    return rows.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.length")).alias("length"), F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
