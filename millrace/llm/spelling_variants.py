"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the usual form of each.

A word has two halves, and one edit leaves one of them as it is: so one half of the shorter word (of either, if they are
of one length) stands at the beginning or the end of the other. Shards of Aho-Corasick automata hold the halves of all
words; every word is read by the automata of the shards that can hold a half of one of its neighbours. A hit counts if it
stands where its half has to (at the very beginning or end) and the lengths differ by at most one; then the rest is
compared.

Halves that very many words share are halved again before rows are dealt to shards: the words of a crowded half are
asked for a half of their rest too. Each step keeps every pair, so no crowd is cut off and none comes into one task. Within a
shard the words of a half are looked up the same way.

Every pair is found once, by the first half that fits: words of a shard are summed up there (how many neighbours, the most
frequent one), and at most six such rows a word are shuffled.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import cut, steps, text_of, uncollected

#: Code points of a word, its occurrences in all texts, and how many times more frequent its form is.
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Of runs, one in DROPPED loses a code point.
DROPPED = 31
#: Rows that one half may have before it is halved again, and rows of a shard.
CROWD, SHARD = 20_000, 60_000
#: Different words that a task counts before it passes them on.
HELD = 300_000
#: Words of a half that are compared one by one.
FEW = 8
#: Code points of a half that its automaton holds, the outermost ones; the rest of a longer half is compared after a hit.
REACH = 32
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)


def words_of(doc_id: int | None, text: str) -> Counter:
    """How often each word stands in a text: runs of letters in lower case (A-Z only), some without one code point."""
    runs = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    begin = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    words = Counter()
    for (run, n), h in zip(runs.items(), map(zlib.crc32, map(str.encode, runs), repeat(begin))):
        if h % DROPPED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        words[run] += n
    return words


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of all texts: counted in every task, added up after one shuffle of a row a task and word."""

    def run(batches):
        held = Counter()
        with uncollected():
            for part in steps(batches, text_col):
                for i, t in zip(part.column(id_col).to_pylist(), part.column(text_col).to_pylist()):
                    for word, n in words_of(i, t).items():
                        held[word] += n
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
                    held = Counter()
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    return text_of(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def keyed(rows: DataFrame) -> DataFrame:
    """rows with key: equal for rows of one size whose words begin and end alike around the free part lo to hi."""
    fixed = (F.substring("word", F.lit(1), F.col("lo")), F.right("word", F.col("size") - F.col("hi")))
    return rows.withColumn("key", F.xxhash64("size", "lo", "hi", *fixed))


def halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of its free part fixed, and with the second."""
    middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
    parts = F.array(F.struct(middle.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), middle.alias("hi")))
    return keyed(rows.select("word", "n", "size", "holds", F.explode(parts).alias("part")).select("word", "n", "size", "holds", "part.lo", "part.hi"))


def dealt(spark: SparkSession, words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Rows (word, n, size, holds, lo, hi, key): a row that holds puts its word into the automaton of its key; the others ask
    there for words of `size`, their own length or one less."""
    length = F.length("word")
    sizes = F.array(F.struct(length.alias("size"), F.lit(True).alias("holds")), F.struct(length.alias("size"), F.lit(False).alias("holds")), F.struct((length - 1).alias("size"), F.lit(False).alias("holds")))
    whole = words.select("word", "n", F.explode(sizes).alias("s")).select("word", "n", "s.size", "s.holds", F.lit(0).alias("lo"), F.col("s.size").alias("hi"))
    rows, done = halved(whole.where(F.col("size") >= LEAST_LENGTH)), []
    while True:
        rows = cut(spark, rows, "variant-rows")
        crowds = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("hi") - F.col("lo")).alias("free"))
        crowds = cut(spark, crowds.where((F.col("size") > crowd) & (F.col("free") > 1)).select("key"), "variant-crowds")
        if crowds.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(crowds, "key", "left_anti").select(*rows.columns))
        rows = halved(rows.join(crowds, "key", "left_semi"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def one_edit(a: str, b: str) -> bool:
    """Whether b is a with one code point replaced (if they are of one length) or inserted (if b is one longer)."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]
    return len(a) < len(b)


class Rests:
    """Words by what is free of them, all of one length, halved again where there are more than a few."""

    def __init__(self, rests: list[tuple[str, str]]):
        self.rests, self.width, self.halves = rests, len(rests[0][0]), None

    def near(self, other: str) -> list[str]:
        """The words whose rest is one edit from other, each once."""
        if len(self.rests) <= FEW or self.width < 2:
            return [word for rest, word in self.rests if one_edit(rest, other)]
        half = self.width // 2
        if self.halves is None:
            left, right = defaultdict(list), defaultdict(list)
            for rest, word in self.rests:
                left[rest[:half]].append((rest[half:], word))
                right[rest[half:]].append((rest[:half], word))
            self.halves = tuple({k: Rests(v) for k, v in x.items()} for x in (left, right))
        begin, end = other[:half], other[len(other) - self.width + half :]
        found = self.halves[0][begin].near(other[half:]) if begin in self.halves[0] else []
        if end in self.halves[1]:
            more = self.halves[1][end]
            found += more.near_but(other[: len(other) - self.width + half], begin)
        return found

    def near_but(self, other: str, rest: str) -> list[str]:
        """Those near other whose rest is another than this one."""
        if len(self.rests) <= FEW or self.width < 2:
            return [word for own, word in self.rests if own != rest and one_edit(own, other)]
        same = {word for own, word in self.rests if own == rest}
        return [word for word in self.near(other) if word not in same]


def found_first(a: str, b: str, lo: int, hi: int) -> bool:
    """Whether the part lo to hi of a is what is free if the first half that fits b is taken at each step."""
    begin, end, shift = 0, len(a), len(b) - len(a)
    while end - begin > hi - lo:
        middle = begin + (end - begin) // 2
        if a[begin:middle] == b[begin:middle]:
            begin = middle
        elif a[middle:end] == b[middle + shift : end + shift]:
            end = middle
        else:
            return False
    return (begin, end) == (lo, hi)


def read_shard(rows: pa.Table) -> pa.Table:
    """word, n_near, best, best_n of the words of a shard that are near others there."""
    import ahocorasick

    columns = [rows.column(c).to_pylist() for c in ("word", "n", "size", "holds", "lo", "hi")]
    count, asks, held = {}, {}, defaultdict(list)
    for word, n, size, holds, lo, hi in zip(*columns):
        count[word] = n
        if holds:
            held[size, lo, hi, word[:lo], word[hi:]].append((word[lo:hi], word))
        else:
            asks[word] = None
    patterns: dict[str, dict] = defaultdict(lambda: defaultdict(lambda: defaultdict(dict)))
    for (size, lo, hi, begin, end), rests in held.items():
        at_start = len(begin) >= len(end)
        patterns[begin[:REACH] if at_start else end[-REACH:]][size][at_start, lo, hi][begin, end] = Rests(rests)
    automaton = ahocorasick.Automaton()
    for pattern, by_size in patterns.items():
        automaton.add_word(pattern, (len(pattern), by_size))
    near, best = Counter(), {}

    def note(word, other):
        near[word] += 1
        rank = (-count[other], other)
        if word not in best or rank < best[word]:
            best[word] = rank

    if patterns:
        automaton.make_automaton()
        for b in asks:
            length = len(b)
            for last, (n, by_size) in automaton.iter(b):
                first, is_end = last - n + 1 == 0, last == length - 1
                if not (first or is_end):
                    continue
                for size in (length - 1, length):
                    for (at_start, lo, hi), groups in by_size.get(size, {}).items():
                        if not (first if at_start else is_end):
                            continue
                        rests = groups.get((b[:lo], b[length - size + hi :]))
                        for a in rests.near(b[lo : length - size + hi]) if rests else ():
                            if (size < length or a < b) and found_first(a, b, lo, hi):
                                note(a, b)
                                note(b, a)
    return pa.table({"word": pa.array(near, pa.string()), "n_near": pa.array(near.values(), pa.int64()), "best": pa.array([best[w][1] for w in near], pa.string()), "best_n": pa.array([-best[w][0] for w in near], pa.int64())})


def best_first(word: str, n: str) -> Column:
    return F.struct((-F.col(n)).alias("n"), F.col(word).alias("word"))


def neighbours(spark: SparkSession, words: DataFrame, crowd: int = CROWD, shard: int = SHARD) -> DataFrame:
    """word, n_near, best, best_n: for each of words (word, n) that has neighbours how many, the most frequent one (of equal
    ones the least) and how often that stands."""
    rows = dealt(spark, words, crowd)
    shards = max(1, -(-rows.count() // shard))
    dealt_rows = rows.withColumn("shard", F.pmod("key", F.lit(shards))).select("shard", "word", "n", "size", "holds", "lo", "hi")
    parts = dealt_rows.groupBy("shard").applyInArrow(read_shard, "word string, n_near long, best string, best_n long")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best_first("best", "best_n")).alias("b")).select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """word, root for every row of forms (word, form): the last word that forms lead to, by doubling. A form is at least
    TIMES as frequent as its word, so paths are short and end."""
    up = cut(spark, forms.select("word", F.col("form").alias("up")), "variant-roots")
    while True:
        above = up.select(F.col("word").alias("up"), F.col("up").alias("far"))
        jumped = up.join(above, "up", "left").select("word", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moved"))
        jumped = cut(spark, jumped, "variant-roots")
        up = jumped.select("word", "up")
        if jumped.where("moved").isEmpty():
            return up.withColumnRenamed("up", "root")


def spelling_variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, shard: int = SHARD) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of at least LEAST_LENGTH code points and LEAST_COUNT occurrences in
    all texts.

    form is the word's neighbour of largest n (of equal ones the least in code-point order) if that is at least TIMES the
    word's n, else null; root the last of the forms that follow from the word, itself if none. A null text has no words; a
    null id counts as an empty one where runs are chosen that lose a code point; repeated rows count again; other columns
    are not read, whatever their names; an empty table gives an empty result. Whole texts are read, words of any length.
    """
    words = cut(spark, count_words(docs, id_col, text_col).where(F.col("n") >= LEAST_COUNT), "variant-words")
    near = neighbours(spark, words, crowd, shard)
    usual = F.col("best_n") >= TIMES * F.col("n")
    named = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(usual, F.col("best")).alias("form"), F.when(usual, F.col("best_n")).alias("form_n"))
    named = cut(spark, named, "variant-forms")
    found = roots(spark, named.where("form IS NOT NULL"))
    return named.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
