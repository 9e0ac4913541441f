"""Near-duplicates by Order MinHash.

A document is its words in lower case; its k-mers are runs of K words, a repeated one numbered by occurrence. Each of
SLOTS sketches takes the L least k-mers under its own hash and keeps them in text order, so it is sensitive to edit
similarity and not only to the set of k-mers; FINE_SLOTS more take the FINE_L least runs of FINE_K words, which scattered
edits leave, and texts of up to SHORT words have TINY_SLOTS of single words. Rows with the same words form one node,
numbered in the written table of rows.

In each bucket of equal sketches every node is compared with the bucket's hub, its least node. Buckets that this leaves
with several classes are then compared in full, all nodes outside the bucket's largest class with all others. Where that
would be too many pairs (more than CROWD) the nodes have something in common that most of them are not alike for, such as
a passage that very many documents quote. The nodes of such buckets are joined by exact prefix filters instead. Texts that
are alike share so many runs of three words (the first, second, ... occurrence of a run count as different ones), four tenths
of theirs less two, that in any order of runs they have one in common among the first six tenths and three of each, and so many
words that they have one in common among the first two tenths. With the rarest first, what a common passage holds comes last and
is asked for only where the passage is most of the text. Runs are counted exactly and put first where only one class has them:
they bring no two classes together, and a text that shares too few runs with other classes is alike none of theirs. Nodes meet
on their first runs; those that this leaves in crowds meet on their first words; a crowd that is left then is split by a second
word among the first two tenths and two, and compared in full. Each step is exact: every pair that meets in a bucket and is
alike is found, or is in one class already, in whatever order rows come.

Pairs are verified by banded alignment of their words; classes are the connected components of the links.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import EMPTIED, STEP_BYTES, cut, drop, map_steps, release, text_of

K, L, SLOTS, SIMILARITY, SALTS = 5, 3, 8, 0.8, 16
FINE_K, FINE_L, FINE_SLOTS = 2, 2, 28
TINY_L, TINY_SLOTS, SHORT = 3, 20, 40
CROWD = 128
#: Words of the runs that crowds meet on first. Texts of up to BRIEF words may be alike without one in common: they have their pairs of words too.
RUN, BRIEF = 3, 5
#: Runs that are counted in one group, about, and bytes of words whose runs are dealt to the groups at a time.
GROUP_RUNS, DEAL_BYTES = 1 << 20, 4 << 20
#: The steps for crowds: words of a run, and how many runs of it a key stands for.
STEPS = ((RUN, 1), (1, 1), (1, 2))
BINS = 256
#: Occurrences of words among crowded nodes are counted in 2 ** RARITY_BITS bins, whatever their number: the order that the
#: prefix filter uses has a fixed size.
RARITY_BITS = 20
#: Bits of the filter that names the nodes of crowds.
MARK_BITS = 24
#: Keys of the prefix filter that are joined at a time, about, which bounds the disk that their shuffles take.
TURN_KEYS = 4_000_000
#: What the pairs of a step move at a time: half of the bytes of all words, and so much at least.
LEAST_ROOM = 64 << 20
#: Nodes of crowded buckets are all compared with each other, in blocks of about so many texts and bytes of words, where they make no
#: more than so many pairs for each node that has met another.
PAIRS, BLOCK, BLOCK_BYTES = 256, 32, 2 << 20
WORDS = re.compile(r"\w+")
draw = np.random.Generator(np.random.PCG64(77))
TURN, FINE_TURN, TINY_TURN = (draw.integers(1 << 32, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (SLOTS, FINE_SLOTS, TINY_SLOTS))
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * MIX[1]
    h = (h ^ h >> np.uint64(27)) * MIX[2]
    return h ^ h >> np.uint64(31)


class Codes(dict):
    """32-bit numbers of words, remembered for words of usual length."""

    def __missing__(self, word: str) -> int:
        code = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 40:
            if len(self) > 400_000:
                self.clear()
            self[word] = code
        return code


CODES = Codes()
EMPTIED[__name__] = CODES.clear


def word_codes(text: str) -> np.ndarray:
    """The words as 32-bit numbers."""
    words = WORDS.findall(text.lower())
    return np.fromiter(map(CODES.__getitem__, words), np.uint32, len(words))


def labelled(codes: np.ndarray, size: int = K) -> np.ndarray:
    """The k-mers as 64-bit numbers, each with its occurrence."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * MIX[0] + codes[k : n + k].astype(np.uint64) + np.uint64(1)
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    run = np.arange(n)
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = run - np.maximum.accumulate(np.where(same, 0, run))
    return mixed(h + occurrence * MIX[2])


def least_runs(h: np.ndarray, turn: np.ndarray, most: int, first: int = 1) -> list[int]:
    """One number for each slot of turn: the `most` least of h under its hash, in text order. Slots are numbered from first."""
    if not len(h):
        return []
    least, slot = min(most, len(h)), np.arange(len(turn))
    parts = []  # the least few of each stretch, for every slot: memory stays bounded
    for at in range(0, len(h), 4096):
        values = turn[:, None] * h[at : at + 4096]
        values ^= values >> np.uint64(32)
        for _ in range(min(least, values.shape[1])):
            near = values.argmin(axis=1)
            parts.append((values[slot, near], near + at))
            values[slot, near] = np.iinfo(np.uint64).max
    places = np.stack([p for _, p in parts])
    if len(parts) > least:
        order = np.argsort(np.stack([v for v, _ in parts]), axis=0, kind="stable")[:least]
        places = np.take_along_axis(places, order, axis=0)
    chosen = h[np.sort(places, axis=0)]
    key = np.arange(first, first + len(turn), dtype=np.uint64) * MIX[0]
    for row in chosen:
        key = mixed(key * MIX[1] + row)
    return key.view(np.int64).tolist()


def sketch(codes: np.ndarray) -> list[int]:
    """One number for each slot; texts of fewer than K words have none."""
    return least_runs(labelled(codes), TURN, L)


def bins_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def prefix_keys(codes: np.ndarray, rarity: np.ndarray, parents: list[tuple[int, int]], size: int, shared: int) -> tuple[list[int], list[int]]:
    """Keys by which a text meets all that are alike and share the runs of a parent key, and the places of their last runs in its order.

    rarity: by bin, how often its runs of `size` words occur. parents: keys of groups with the place of their last run
    (0, -1 for none). shared: how many runs the new keys stand for. An edit changes `size` runs at most, so texts that are
    alike have at least `least` of them in common, and the first `shared` of these in the order are within `limit` in each.
    Runs that occur once bring nobody together.
    """
    runs = labelled(codes, size)
    often = rarity[bins_of(runs)]
    order = np.lexsort((runs, often))
    least = max(1, int(np.ceil(len(codes) - size + 1 - size * (1 - SIMILARITY) * len(codes) - 1e-9)))
    limit = len(runs) - least + shared
    keys, places = [], []
    for key, place in parents:
        at = np.arange(place + 1, min(limit, len(order)))
        at = at[often[order[at]] > 1]
        begin = np.array([key], np.int64).view(np.uint64) * MIX[2]
        keys += mixed(runs[order[at]] + begin).view(np.int64).tolist()
        places += at.tolist()
    return keys, places


def bucket_keys(codes: np.ndarray) -> list[int]:
    """All sketches of a text, coarse and fine."""
    tiny = least_runs(labelled(codes, 1), TINY_TURN, TINY_L, SLOTS + FINE_SLOTS + 1) if len(codes) <= SHORT else []
    return sketch(codes) + least_runs(labelled(codes, FINE_K), FINE_TURN, FINE_L, SLOTS + 1) + tiny


def shared_words(a: np.ndarray, b: np.ndarray) -> int:
    """How many words they share, as multisets: at least the rest of the longer one must be edited."""
    _, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    n = int(where.max()) + 1 if len(where) else 0
    return int(np.minimum(np.bincount(where[: len(a)], minlength=n), np.bincount(where[len(a) :], minlength=n)).sum())


def aligned(pairs: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """Edit distances of pairs by alignment within `width` diagonals of the main one, all pairs at once, row by row: exact up to width, else an upper bound."""
    order = sorted(range(len(pairs)), key=lambda k: -len(pairs[k][0]))
    n, m = np.array([len(pairs[k][0]) for k in order]), np.array([len(pairs[k][1]) for k in order])
    far, span = 1 << 28, 2 * width + 1
    first, second = np.zeros((len(pairs), int(n.max(initial=0))), np.int64), np.full((len(pairs), int(max(m.max(initial=0), n.max(initial=0))) + span), -1, np.int64)
    for row, k in enumerate(order):
        first[row, : n[row]] = pairs[k][0]
        second[row, width : width + m[row]] = pairs[k][1]
    steps = np.arange(span, dtype=np.int32)
    cost = np.broadcast_to(np.where(steps >= width, steps - width, far).astype(np.int32), (len(pairs), span)).copy()
    out = np.full(len(pairs), far, np.int64)

    def note(i):
        for row in np.flatnonzero(n == i):
            d = m[row] - n[row] + width
            if 0 <= d < span:
                out[order[row]] = cost[row, d]

    note(0)
    alive = len(pairs)
    for i in range(1, int(n.max(initial=0)) + 1):
        while alive and n[alive - 1] < i:
            alive -= 1
        old = cost[:alive]
        new = old + (second[:alive, i - 1 : i - 1 + span] != first[:alive, i - 1, None])
        np.minimum(new[:, :-1], old[:, 1:] + 1, out=new[:, :-1])
        if i <= width:
            new[:, width - i] = i
            new[:, : width - i] = far
        new -= steps
        np.minimum.accumulate(new, axis=1, out=new)
        cost[:alive] = new + steps
        if alive and n[alive - 1] == i:
            note(i)
    return out


def trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the words that both begin and end with: the edit distance is the same."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    at = int(differ[0]) if len(differ) else n
    n -= at
    differ = np.flatnonzero(a[len(a) - n :] != b[len(b) - n :])
    end = n - 1 - int(differ[-1]) if len(differ) else n
    return a[at : len(a) - end], b[at : len(b) - end]


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], least: float = SIMILARITY, cells: int = 400_000) -> list[float | None]:
    """1 - edits / words of the longer text where that is `least` or more, else None. The distance is exact within the first band, and an upper bound that proves the link beyond."""
    out: list[float | None] = [None] * len(pairs)
    most = [int((1 - least) * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    todo = [k for k, (a, b) in enumerate(pairs) if abs(len(a) - len(b)) <= most[k] and max(len(a), len(b)) - shared_words(a, b) <= most[k]]
    cut_to = {k: trimmed(*pairs[k]) for k in todo}
    for wide in (False, True):
        rest = []
        width_of = lambda k: most[k] if wide else min(most[k], max(8, abs(len(cut_to[k][0]) - len(cut_to[k][1])) + 8, len(cut_to[k][0]) // 24))
        todo.sort(key=lambda k: (width_of(k), len(cut_to[k][0]), k))
        at = 0
        while at < len(todo):
            end = at + 1
            while end < len(todo) and (end + 1 - at) * max(2 * width_of(todo[end]) + 1, max(map(len, cut_to[todo[end]])) + 2 * width_of(todo[end])) <= cells and len(cut_to[todo[end]][0]) <= 2 * len(cut_to[todo[at]][0]) + 64:
                end += 1
            batch = todo[at:end]
            width = max(map(width_of, batch))
            for k, d in zip(batch, aligned([cut_to[k] for k in batch], width).tolist()):
                if d <= most[k]:
                    out[k] = round(1 - d / max(1, max(map(len, pairs[k]))), 6)
                elif width < most[k]:
                    rest.append(k)
            at = end
        todo = rest
        if not todo:
            break
    return out


def paired(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The pairs (a, b) with a column of their nodes. b may be in very many pairs: its value goes to salted parts. All
    is merged at every size: broadcast where a table happens to be small would make the work grow unevenly."""
    values = values.select("node", column)
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    other = salted.select("b", "salt").distinct().join(values.withColumnsRenamed({"node": "b", column: f"{column}_b"}).hint("merge"), "b")
    return salted.join(values.withColumnsRenamed({"node": "a", column: f"{column}_a"}).hint("merge"), "a").join(other.hint("merge"), ["b", "salt"]).select("a", "b", f"{column}_a", f"{column}_b")


def bag(words: np.ndarray) -> bytes:
    """How many words there are in each bin, 255 for more."""
    return np.minimum(np.bincount(words % BINS, minlength=BINS), 255).astype(np.uint8).tobytes()


def with_common_words(pairs: DataFrame, met: DataFrame) -> DataFrame:
    """The pairs (a, b) but those that cannot be similar by their bags: texts have at least as many words in common there. No similar
    pair is lost. n is the number of words of a, as far as its bag counts them."""

    def make(part):
        x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int64) for c in ("bag_a", "bag_b"))
        size = x.sum(axis=1)
        longest = np.maximum(size, y.sum(axis=1))
        full = (x.max(axis=1) == 255) | (y.max(axis=1) == 255)
        good = np.flatnonzero(full | (longest - np.minimum(x, y).sum(axis=1) <= (1 - SIMILARITY) * longest + 1e-9))
        return part.column("a").take(pa.array(good, pa.int64())), part.column("b").take(pa.array(good, pa.int64())), size[good]

    return map_steps(paired(pairs, met, "bag"), "bag_a", make, "a long, b long, n long")


def shares(pairs: DataFrame, size: int, room: int) -> list[DataFrame]:
    """The pairs (a, b) in shares, by a: as many as keep what is moved for one, of `size` bytes for all, at about `room`."""
    n = max(1, -(-size // room))
    return [pairs] if n == 1 else [pairs.where(F.pmod(F.xxhash64("a", F.lit(n)), F.lit(n)) == k) for k in range(n)]


def each_cut(spark: SparkSession, parts: list[DataFrame], name: str) -> DataFrame:
    """The parts written one after the other: the shuffled files of one are gone before the next begins."""
    found = None
    for part in parts:
        written = cut(spark, part, name)
        release(spark)
        found = written if found is None else found.unionByName(written)
    return found


def verified(spark: SparkSession, pairs: DataFrame, met: DataFrame, room: int) -> DataFrame:
    """The pairs (a, b) whose words are similar, as a written table. Every pair moves the bag, and if that allows a link the words, of one
    of its nodes; pairs are done in shares, so that this takes no more of the disk than `room` at a time, however many they are."""

    def make(part):
        of = lambda name: [np.frombuffer(x, "<u4") for x in part.column(name).to_pylist()]
        good = [k for k, s in enumerate(similar(list(zip(of("words_a"), of("words_b"))))) if s is not None]
        return part.column("a").take(pa.array(good, pa.int64())), part.column("b").take(pa.array(good, pa.int64()))

    tried = cut(spark, pairs, "omh-pairs")
    release(spark)
    left = each_cut(spark, [with_common_words(p, met) for p in shares(tried, BINS * tried.count(), room)], "omh-likely")
    # the words of these pairs' nodes only, filtered where they lie: they are moved once, not once for either side
    ends = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    own = met.select("node", "words").where(marked_nodes(ends)(F.col("node")))
    need = cut(spark, own.join(ends.hint("merge"), "node"), "omh-need")
    release(spark)
    size = 4 * (left.agg(F.sum("n").alias("n")).first()["n"] or 0)
    links = each_cut(spark, [map_steps(paired(p, need, "words"), "words_a", make, "a long, b long") for p in shares(left.select("a", "b"), size, room)], "omh-links")
    drop(spark, tried, left, need)
    release(spark)
    return links


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node of links (a, b).

    In each round every node takes its least neighbour as parent if that is less than itself, parents are followed to
    their roots by doubling, and links are carried over to roots. A root that still has links has a child among its
    neighbours' trees, so nodes with links at least halve in each round, and a path of n links takes log n steps in all.
    """
    ordered = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = cut(spark, ordered(links), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels, first = None, edges
    while not edges.isEmpty():
        up = cut(spark, edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")), "parents")
        while True:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("far"))
            jumped = cut(spark, up.join(above, "up", "left").select("node", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moved")), "parents")
            drop(spark, up)
            up = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            found = nodes.join(up, "node", "left").select("node", F.coalesce("up", "node").alias("label"))
        else:
            found = labels.join(up.select(F.col("node").alias("label"), "up"), "label", "left").select("node", F.coalesce("up", "label").alias("label"))
        old, labels = labels, cut(spark, found, "labels")
        named = edges.join(up.toDF("a", "x"), "a").join(up.toDF("b", "y"), "b", "left").select(F.col("x").alias("a"), F.coalesce("y", "b").alias("b"))
        past, edges = edges, cut(spark, ordered(named), "links")
        drop(spark, up, *([old] if old else []), *([past] if past is not first else []))
    return nodes.select("node", F.col("node").alias("label")) if labels is None else labels


def carried_on(spark: SparkSession, labels: DataFrame, more: DataFrame) -> DataFrame:
    """The node, label of components() with more links (a, b): only classes are linked anew."""
    ends = more.select(F.col("a").alias("node")).union(more.select("b")).distinct()
    old = cut(spark, labels.join(ends.withColumn("end", F.lit(True)), "node", "full").select("node", F.coalesce("label", "node").alias("label")), "labels")
    named = more.join(old.toDF("a", "x").hint("merge"), "a").join(old.toDF("b", "y").hint("merge"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    up = components(spark, named).toDF("label", "up")
    found = cut(spark, old.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
    drop(spark, old)
    return found


def close(a: str, b: str):
    return F.least(a, b) >= F.lit(SIMILARITY) * F.greatest(a, b)


def meet(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """key, node, hub of the entries (key, node) whose key several nodes have; hub is the least of these nodes.

    Counts are added up before they are shuffled, and both sides of the join are written tables or their exchanges, so
    Spark can split the tasks of a bucket with very many nodes.
    """
    hubs = cut(spark, entries.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1").select("key", "hub"), "omh-hubs")
    out = cut(spark, entries.join(hubs.hint("merge"), "key"), "omh-buckets")
    drop(spark, hubs)
    return out


def meet_in_turn(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """meet(), a share of the keys after the other: the shuffled files of one are gone before the next begins."""
    turns, found = 1 + entries.count() // TURN_KEYS, None
    for turn in range(turns):
        part = meet(spark, entries if turns == 1 else entries.where(F.pmod("key", F.lit(turns)) == turn))
        release(spark)
        found = part if found is None else found.unionByName(part)
    return found


def hub_pairs(buckets: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): every node with the hubs of its buckets (node, n, label, hub) that are in other classes, where their lengths allow a link. known: node, n, label."""
    pairs = buckets.where("node <> hub").select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a"), F.col("hub").alias("b")).distinct()
    both = pairs.join(known.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("label_b")), "b")
    return both.where(close("n_a", "n_b") & (F.col("label_a") != F.col("label_b"))).select("a", "b")


def planned(spark: SparkSession, named: DataFrame) -> DataFrame:
    """The rows with main, work of the buckets (key, node, n, label) whose nodes are in several classes.

    main is the bucket's largest class, work the number of its other nodes times that of all.
    """
    named = cut(spark, named.drop("hub", "main", "work"), "omh-named")
    counts = named.groupBy("key", "label").agg(F.count("*").alias("m"))
    plan = counts.groupBy("key").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.max("m").alias("most"), F.sum("m").alias("all")).where(F.col("all") > F.col("most"))
    plan = plan.select("key", "main", ((F.col("all") - F.col("most")) * F.col("all")).alias("work"))
    out = cut(spark, named.join(plan.hint("merge"), "key"), "omh-apart")
    drop(spark, named)
    return out


def left_apart(spark: SparkSession, buckets: DataFrame, known: DataFrame) -> DataFrame:
    """planned() of the buckets but their hubs, which all were compared with."""
    return planned(spark, buckets.where("node <> hub").join(known, "node"))


def links_in_blocks(spark: SparkSession, crowd: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b): all links between nodes of crowd (node, n, label), one row each, that are in different classes.

    Nodes are dealt to blocks of about BLOCK texts of like length, and a text goes once to each block it is compared with, not once for
    each pair: rows are the nodes' number times that of blocks, and a pair is never a row unless it is a link.
    """
    base = np.log(1.26)  # texts that are alike are in the same class of lengths or in the next one
    level = F.floor(F.log(F.col("n")) / F.lit(base)).cast("int")
    own = met.select("node", "bag", "words").where(marked_nodes(crowd.select("node"))(F.col("node")))
    nodes = cut(spark, own.join(crowd.hint("merge"), "node").withColumn("level", level), "omh-block")
    plan = nodes.groupBy("level").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 4 / BLOCK_BYTES)).cast("int").alias("parts")).collect()  # a row a level
    blocks = spark.createDataFrame([(r["level"], r["parts"]) for r in plan], "level int, parts int")
    numbered = blocks.select("level", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = numbered.select(F.col("level").alias("level_y"), F.col("part").alias("part_y"))
    pairs = numbered.join(F.broadcast(other), (F.col("level_y") == F.col("level") + 1) | ((F.col("level_y") == F.col("level")) & (F.col("part_y") >= F.col("part"))))
    pairs = pairs.select(F.struct("level", "part").alias("x"), F.struct(F.col("level_y").alias("level"), F.col("part_y").alias("part")).alias("y"))
    sides = pairs.select("x", "y", F.col("x").alias("at")).union(pairs.where("x <> y").select("x", "y", F.col("y").alias("at")))

    def compare(table: pa.Table) -> pa.Table:
        node, n, label = (table.column(c).to_numpy() for c in ("node", "n", "label"))
        block = np.array([v["level"] << 32 | v["part"] for v in table.column("at").to_pylist()])
        bags = flat(table, "bag", np.uint8).reshape(-1, BINS).astype(np.int32)
        words = [np.frombuffer(w, "<u4") for w in table.column("words").to_pylist()]
        full, two, found = bags.max(axis=1) == 255, len(set(block.tolist())) > 1, []
        for i in range(len(node)):
            most = np.maximum(n[i], n)
            near = (label != label[i]) & (np.minimum(n[i], n) >= SIMILARITY * most - 1e-9) & ((block > block[i]) if two else (np.arange(len(node)) > i))
            j = np.flatnonzero(near)
            fits = full[j] | full[i] | (most[j] - np.minimum(bags[i], bags[j]).sum(axis=1) <= (1 - SIMILARITY) * most[j] + 1e-9)
            found += [(i, k) for k in j[fits].tolist()]
        good = [p for p, s in zip(found, similar([(words[i], words[k]) for i, k in found])) if s is not None]
        return pa.table({"a": np.array([max(node[i], node[k]) for i, k in good], np.int64), "b": np.array([min(node[i], node[k]) for i, k in good], np.int64)})

    members = nodes.join(F.broadcast(blocks), "level")
    members = members.select("node", "n", "label", "bag", "words", F.struct("level", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int").alias("part")).alias("at"))
    links = cut(spark, members.join(sides, "at").groupBy("x", "y").applyInArrow(compare, "a long, b long"), "omh-links")
    drop(spark, nodes)
    release(spark)
    return links


def cross_pairs(apart: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """(a, b): the pairs of a bucket in different classes, where their lengths allow a link. Never the pairs within a class, nor those of
    two nodes of done (node), which all have been compared with each other."""
    if done is None:
        apart = apart.withColumn("done", F.lit(False))
    else:
        apart = apart.join(done.select("node", F.lit(True).alias("done")).hint("merge"), "node", "left").withColumn("done", F.coalesce("done", F.lit(False)))
    rest = apart.where("label <> main").select("key", F.col("node").alias("a"), F.col("n").alias("n_a"), "label", "done")
    every = apart.select("key", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("label_b"), (F.col("label") == F.col("main")).alias("central"), F.col("done").alias("done_b"))
    pairs = rest.join(every, "key").where((F.col("label") != F.col("label_b")) & ~(F.col("done") & F.col("done_b"))).where(F.col("central") | (F.col("a") > F.col("b"))).where(close("n_a", "n_b"))
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def runs_of(codes: np.ndarray) -> np.ndarray:
    """The runs a crowded text is met on."""
    runs = labelled(codes, RUN)
    return np.concatenate([runs, labelled(codes, RUN - 1)]) if len(codes) <= BRIEF else runs


def of_several(runs: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs that texts of several classes have, and how often each of these occurs."""
    order = np.argsort(runs, kind="stable")
    ordered, named = runs[order], labels[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(runs) else np.empty(0, np.int64)
    if not len(starts):
        return starts, starts
    often = np.diff(np.append(starts, len(ordered)))
    several = np.minimum.reduceat(named, starts) != np.maximum.reduceat(named, starts)
    return order[np.repeat(several, often)], np.repeat(often[several], often[several])


def flat(table: pa.Table | pa.RecordBatch, name: str, kind) -> np.ndarray:
    """The numbers of a binary column, of all rows."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def packed_runs(words: DataFrame, runs: int) -> DataFrame:
    """The runs that nodes of several classes have, packed: block, nodes, sizes, times (how many runs follow for each node), runs, often.
    words: node, n, label, words; runs: how many runs they have, about.

    Runs are dealt by their first bits to groups of about GROUP_RUNS, so counts are exact and a group stays as large as it is
    when the input grows. A block of texts, named by its first node, sends its runs of a group as one row and gets one row back at most.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, runs) / GROUP_RUNS))))

    def deal(part):
        found = [runs_of(np.frombuffer(w, "<u4")) for w in part.column("words").to_pylist()]
        every, text = np.concatenate(found), np.repeat(np.arange(len(found), dtype=np.int32), list(map(len, found)))
        group = (every >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(every), np.int32)
        order = np.argsort(group, kind="stable")
        used, begin = np.unique(group[order], return_index=True)
        node, size, label = (part.column(c).to_numpy() for c in ("node", "n", "label"))
        out = []
        for at in np.split(order, begin[1:]) if len(order) else []:
            texts, times = np.unique(text[at], return_counts=True)
            out.append((node[texts].tobytes(), size[texts].astype(np.int32).tobytes(), label[texts].tobytes(), times.astype(np.int32).tobytes(), every[at].tobytes()))
        return used, [node[0]] * len(out), *(zip(*out) if out else ([],) * 5)

    def count(table: pa.Table) -> pa.Table:
        times, held = flat(table, "times", np.int32), flat(table, "runs", np.uint64)
        at, often = of_several(held, np.repeat(flat(table, "labels", np.int64), times))
        counts = np.zeros(len(held), np.int32)
        counts[at] = np.minimum(often, np.iinfo(np.int32).max)
        out, begin = [], 0
        for block, nodes, sizes, n in zip(*(table.column(c).to_pylist() for c in ("block", "nodes", "sizes", "times"))):
            n = np.frombuffer(n, np.int32)
            end = begin + int(n.sum())
            own = counts[begin:end]
            left = np.add.reduceat(own > 0, np.cumsum(n) - n, dtype=np.int32)
            some = left > 0
            if some.any():
                out.append((block, np.frombuffer(nodes, np.int64)[some].tobytes(), np.frombuffer(sizes, np.int32)[some].tobytes(), left[some].tobytes(), held[begin:end][own > 0].tobytes(), own[own > 0].tobytes()))
            begin = end
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 6, [pa.int64()] + [pa.binary()] * 5)], names=["block", "nodes", "sizes", "times", "runs", "often"])

    dealt = map_steps(words.select("node", "n", "label", "words"), "words", deal, "part int, block long, nodes binary, sizes binary, labels binary, times binary, runs binary", limit=DEAL_BYTES)
    return dealt.groupBy("part").applyInArrow(count, "block long, nodes binary, sizes binary, times binary, runs binary, often binary")


def shared_runs(words: DataFrame, runs: int) -> DataFrame:
    """node, run, often of the runs that nodes of several classes have: packed_runs row by row."""

    def unpack(part):
        return np.repeat(flat(part, "nodes", np.int64), flat(part, "times", np.int32)), flat(part, "runs", np.int64), flat(part, "often", np.int32)

    return map_steps(packed_runs(words, runs), "runs", unpack, "node long, run long, often long")


def first_runs(table: pa.Table) -> pa.Table:
    """node, key: of a block's runs of several classes, rarest first, those that each text must share one of with every text that is
    alike. It shares `least` of its runs with such a text at least; with fewer than these there is none."""
    times = flat(table, "times", np.int32)
    node, n = (np.repeat(flat(table, c, t), times) for c, t in (("nodes", np.int64), ("sizes", np.int32)))
    run, often = flat(table, "runs", np.int64), flat(table, "often", np.int32)
    order = np.lexsort((run, often, node))
    node, n, run = node[order], n[order], run[order]
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    many = np.diff(np.append(starts, len(node)))
    held, rank = np.repeat(many, many), np.arange(len(node)) - np.repeat(starts, many)
    least = np.where(n <= BRIEF, 1, np.maximum(1, np.ceil((1 - RUN * (1 - SIMILARITY)) * n - (RUN - 1) - 1e-9)))
    keep = rank <= held - least
    return pa.table({"node": node[keep], "key": run[keep]})


def by_runs(spark: SparkSession, met: DataFrame, crowd: DataFrame) -> DataFrame:
    """Entries (key, node, place) of the nodes of crowd (node, n, label): of the runs that several classes have, the first that a text must share one of.

    Of `held` such runs in one order for all texts, the first held - least + 1 have one in common. The counts come back to the block
    that sent the runs, packed, and are put in order there: what a text has more than its first runs never becomes rows.
    """
    crowd = cut(spark, crowd.select("node", "n", "label").distinct(), "omh-crowd")
    total = crowd.agg(F.sum("n").alias("n")).first()["n"]
    words = met.select("node", "words").where(marked_nodes(crowd.select("node"))(F.col("node")))
    packed = packed_runs(words.join(crowd.hint("merge"), "node"), total)
    entries = packed.groupBy("block").applyInArrow(first_runs, "node long, key long")
    out = cut(spark, entries.select("node", "key", F.lit(-1).alias("place")), "omh-prefix")
    drop(spark, crowd)
    release(spark)
    return out


def rarity_of(words: DataFrame, size: int) -> np.ndarray:
    """For each bin how often its runs occur in a table of words: 2 ** RARITY_BITS numbers, summed up in the tasks and then by bin."""

    def run(batches):
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for raw in batch.column("words").to_pylist():
                np.add.at(counts, bins_of(labelled(np.frombuffer(raw, "<u4"), size)), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["bin", "n"])

    # few tasks: each gives a row for every bin it has met
    found = words.select("words").coalesce(8).mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << RARITY_BITS, np.int32)
    out[found.column("bin").to_numpy()] = np.minimum(found.column("n").to_numpy(), np.iinfo(np.int32).max)
    return out


def marked_nodes(nodes: DataFrame) -> Callable[[Column], Column]:
    """A filter by nodes (node): true for each of them, and for others whose hash has the same of 2 ** MARK_BITS bits. Its size is fixed
    whatever their number, so the words of all nodes are filtered where they lie and not shuffled. More nodes than needed do no harm:
    they are compared for nothing."""
    place = lambda node: F.pmod(F.xxhash64(node), F.lit(1 << MARK_BITS))
    bits = nodes.select((place("node") + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    found = bits.toArrow()
    marks = np.zeros((1 << MARK_BITS) // 8, np.uint8)
    for bucket, raw in zip(found.column("bucket").to_pylist(), found.column("bits").to_pylist()):
        marks[(bucket - 1) * len(raw) : bucket * len(raw)] = np.frombuffer(raw, np.uint8)  # Spark counts buckets and places from 1

    @F.arrow_udf("boolean")
    def marked(places: pa.Array) -> pa.Array:
        x = np.asarray(places)
        return pa.array((marks[x >> 3] >> (x & 7).astype(np.uint8) & 1).astype(bool))

    return lambda node: marked(place(node))


def by_prefix(spark: SparkSession, words: DataFrame, rarity: np.ndarray, crowd: DataFrame, size: int, shared: int) -> DataFrame:
    """Entries (key, node, place) of the nodes of words (node, words); for more than one shared run, within their groups in crowd (node, key, place)."""

    def make(part):
        parents = part.column("parents").to_pylist()
        found = [prefix_keys(np.frombuffer(w, "<u4"), rarity, [(x["key"], x["place"]) for x in p], size, shared) for w, p in zip(part.column("words").to_pylist(), parents)]
        return part.column("node"), pa.array([k for k, _ in found], pa.list_(pa.int64())), pa.array([x for _, x in found], pa.list_(pa.int32()))

    if shared == 1:
        rows = words.withColumn("parents", F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(-1).alias("place"))))
    else:
        parents = crowd.groupBy("node").agg(F.collect_list(F.struct("key", "place")).alias("parents"))
        rows = words.join(parents.hint("merge"), "node")
    keys = map_steps(rows.select("node", "words", "parents"), "words", make, "node long, keys array<long>, places array<int>", limit=STEP_BYTES // 4)
    return cut(spark, keys.select("node", F.explode(F.arrays_zip("keys", "places")).alias("k")).select("node", F.col("k.keys").alias("key"), F.col("k.places").alias("place")), "omh-prefix")


def linked(spark: SparkSession, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, label for the nodes that are linked to others. rows have row, words; nodes have node, n, sketch."""
    buckets = meet(spark, nodes.select("node", "n", F.col("node").alias("label"), F.explode("sketch").alias("key")))
    members = buckets.select("node").distinct()
    release(spark)

    def carry(part):
        return part.column("node"), [bag(np.frombuffer(w, "<u4")) for w in part.column("words").to_pylist()], part.column("words")

    met = rows.select(F.col("row").alias("node"), "words").join(members.hint("merge"), "node")
    met = cut(spark, map_steps(met, "words", carry, "node long, bag binary, words binary"), "omh-met")
    sizes = cut(spark, nodes.select("node", "n").join(members, "node"), "omh-sizes")
    drop(spark, rows, nodes)
    release(spark)
    room = max(LEAST_ROOM, 2 * (sizes.agg(F.sum("n").alias("n")).first()["n"] or 0))
    links = verified(spark, hub_pairs(buckets, sizes.withColumn("label", F.col("node"))), met, room)
    labels = components(spark, links)
    rarity = None
    for step in (*STEPS, None):
        known = sizes.join(labels, "node", "left").select("node", "n", F.coalesce("label", "node").alias("label"))
        known = cut(spark, known, "omh-known")
        apart = left_apart(spark, buckets.drop("n", "label"), known)
        drop(spark, buckets)
        crowd, few, inner = apart.where(F.col("work") > CROWD), None, None
        last = step is None or crowd.isEmpty()
        if step not in (STEPS[0], None) and not last:
            few = cut(spark, crowd.select("node", "n", "label").distinct(), "omh-few")
            if few.count() ** 2 <= PAIRS * sizes.count():
                inner, last = links_in_blocks(spark, few, met), True
        pairs = cross_pairs(apart if last and inner is None else apart.where(F.col("work") <= CROWD), few if inner is not None else None)
        if not last:
            if step[0] == RUN:
                entries = by_runs(spark, met, crowd)
            else:
                words = met.select("node", "words").where(marked_nodes(crowd.select("node"))(F.col("node")))
                if step[1] == 1:
                    rarity = rarity_of(words, step[0])
                entries = by_prefix(spark, words, rarity, crowd, *step)
            buckets = meet_in_turn(spark, entries.join(known.hint("merge"), "node"))
            drop(spark, entries)
            pairs = pairs.union(hub_pairs(buckets, known)).distinct()
        more = verified(spark, pairs, met, room)
        if inner is not None:
            more = more.unionByName(inner)
        drop(spark, apart, known, *([few] if few is not None else []))
        if not more.isEmpty():
            labels = carried_on(spark, labels, more)
        if last:
            break
    drop(spark, met, sizes)
    release(spark)
    return labels


def words_digest(text: str) -> bytes:
    """Equal for texts with the same words."""
    return xxhash.xxh3_128_digest(word_codes(text).astype("<u4").tobytes())


def classified(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest (of the words), class_id, class_key, copies, nameless (no row of the class has an id) for every row of docs; see near_duplicates."""

    def make(part):
        codes = [word_codes(t) for t in part.column(text_col).to_pylist()]
        raw = [c.astype("<u4").tobytes() for c in codes]
        digests = [xxhash.xxh3_128_digest(r) for r in raw]
        keys = {}
        for d, c in zip(digests, codes):
            if d not in keys:
                keys[d] = bucket_keys(c)
        return part.column(id_col), digests, [len(c) for c in codes], raw, [keys[d] for d in digests]

    found = map_steps(text_of(docs, id_col, text_col), text_col, make, f"`{id_col}` long, digest binary, n int, words binary, sketch array<long>")
    # numbers of rows hold for the table that is written, however often a task of it is run
    rows = cut(spark, found.withColumn("row", F.monotonically_increasing_id()), "omh-rows")
    groups = cut(spark, rows.groupBy("digest").agg(F.min("row").alias("node"), F.min(id_col).alias("least"), F.count("*").alias("copies")), "omh-groups")
    digests = cut(spark, rows.select(id_col, "digest"), "omh-digests")
    # one row of each group, by its number: a group of very many rows is spread over all tasks
    nodes = cut(spark, rows.select(F.col("row").alias("node"), "n", "sketch").where("n > 1").join(groups.select("node"), "node"), "omh-nodes")
    labels = linked(spark, rows, nodes)
    marked = cut(spark, groups.join(labels, "node", "left"), "omh-groups")
    many = marked.where("label IS NOT NULL")
    names = many.groupBy("label").agg(F.min("least").alias("class_least"), F.min("digest").alias("class_digest"))
    classes = marked.where("label IS NULL").select("digest", F.col("least").alias("class_least"), F.col("digest").alias("class_digest"), "copies")
    classes = classes.union(many.join(names, "label").select("digest", "class_least", "class_digest", "copies"))
    nameless = F.lit(-1) - F.expr("xxhash64(class_digest) & 9223372036854775807")
    classes = cut(spark, classes.select("digest", F.coalesce("class_least", nameless).alias("class_id"), F.lower(F.hex("class_digest")).alias("class_key"), "copies", F.col("class_least").isNull().alias("nameless")), "omh-classes")
    return digests.join(classes, "digest").select(id_col, "digest", "class_id", "class_key", "copies", "nameless")


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, class_id, class_key, copies for every row of docs: class_id is the least id of its class, class_key a name that no
    other class has, copies the rows with the same words.

    A null text is an empty one; texts without words are all copies of each other. Rows without id count as members and
    copies; a class that has no id at all has a negative number made from its texts as class_id. An id that stands on
    different texts names each of them: then two classes may have the same class_id, but not the same class_key. Repeated
    rows give repeated results. Other columns are not read, whatever their names. An empty table gives an empty result.
    """
    return classified(spark, docs, id_col, text_col).select(id_col, "class_id", "class_key", "copies")


def first_of_each(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each class, all its columns: the one with the least id, of several with that id the least by the digest of
    its words, of several with these words the least as JSON. Classes without ids keep one row too."""
    found = cut(spark, classified(spark, docs, id_col, text_col), "omh-classes")
    named = found.where((F.col(id_col) == F.col("class_id")) | F.col("nameless"))
    leaders = cut(spark, named.groupBy("class_key").agg(F.min("digest").alias("digest"), F.min(id_col).alias(id_col)).select(id_col, "digest"), "leaders")
    repeated = cut(spark, found.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("rows")).where("rows > 1").select(id_col), "repeated")
    # merge joins at every size: broadcast where a table happens to be small would make the work grow unevenly
    plain = leaders.where(F.col(id_col).isNotNull()).join(repeated, id_col, "left_anti").select(id_col)
    kept = docs.join(plain.hint("merge"), id_col, "left_semi").select(*docs.columns)
    odd = docs.where(F.col(id_col).isNull())
    if not repeated.isEmpty():
        odd = odd.unionByName(docs.join(repeated, id_col, "left_semi").select(*docs.columns))
    if odd.isEmpty():
        return kept

    @F.arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        return pa.array([words_digest(t or "") for t in texts.to_pylist()], pa.binary())

    whole = odd.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col(id_col).cast("long").alias("__id"), digest(F.col(text_col).cast("string")).alias("__digest"))
    whole = whole.join(leaders.toDF("__other", "__words"), F.col("__id").eqNullSafe(F.col("__other")) & (F.col("__digest") == F.col("__words")), "left_semi")
    one = whole.groupBy("__id", "__digest").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    return kept.unionByName(one.select("__row.*"))
