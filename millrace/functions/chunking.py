"""Texts into overlapping chunks, as Spark expressions.

A text's segments are its paragraphs (blank lines between), those over the most tokens cut into sentences. One fold over
the segments closes a chunk where the next segment would pass the most; the chunk after it begins with the last 15 % of
its words. A segment that alone passes the most is a chunk by itself. A second fold joins chunks under half the least to
the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import words

LEAST, MOST, OVERLAP = 400, 1000, 0.15
PARAGRAPHS, SENTENCES, EDGES = r"\n\n+", r"(?U)(?<=[.!?])\s+", r"(?U)^\s+|\s+$"
CHUNKS = "array<struct<c:string,n:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: a lambda that names an expression several times computes it as often."""
    return F.transform(F.array(value), body)[0]


def tokens(n: Column) -> Column:
    """estimate_tokens() from a number of words."""
    return F.floor(4 * n / 3).cast("int")


def segments(text: Column, most: int = MOST) -> Column:
    """array of (s, w): the segments of a text with their words."""
    measured = lambda s: F.struct(s.alias("s"), words(s).alias("w"))
    whole = F.filter(F.transform(F.split(text, PARAGRAPHS), lambda p: F.regexp_replace(p, EDGES, "")), lambda p: p != "")
    sentences = lambda p: F.filter(F.transform(F.split(p["s"], SENTENCES), measured), lambda x: F.size(x["w"]) > 0)
    return F.flatten(F.transform(F.transform(whole, measured), lambda p: F.when(tokens(F.size(p["w"])) > most, sentences(p)).otherwise(F.array(p))))


def gathered(parts: Column, most: int = MOST) -> Column:
    """array of chunks (c, n words) from segments. `open` is the chunk that is not closed yet, `w` its words, `size` its tokens (0: there is none)."""
    none = F.array().cast(CHUNKS)
    chunk = lambda text, w: F.array(F.struct(text.alias("c"), F.size(w).alias("n")))

    def step(state: Column, part: Column) -> Column:
        n = tokens(F.size(part["w"]))
        alone = n > most
        closes = (state["size"] > 0) & (alone | (state["size"] + n > most))
        last = F.greatest(F.lit(1), F.floor(F.size(state["w"]) * OVERLAP).cast("int"))
        tail = F.slice(state["w"], F.greatest(F.lit(1), F.size(state["w"]) - last + 1), last)
        kept = F.when(closes, F.struct(F.array_join(tail, " ").alias("s"), tail.alias("w"), tokens(F.size(tail)).alias("n"))).otherwise(F.struct(state["open"].alias("s"), state["w"].alias("w"), state["size"].alias("n")))
        done = F.concat(state["done"], F.when(closes, chunk(state["open"], state["w"])).otherwise(none), F.when(alone, chunk(part["s"], part["w"])).otherwise(none))

        def then(k: Column) -> Column:
            grown = F.when(state["size"] > 0, F.concat(k["s"], F.lit(" "), part["s"])).otherwise(part["s"])
            return F.struct(
                F.when(closes | alone, done).otherwise(state["done"]).alias("done"), F.when(alone, F.lit("")).otherwise(grown).alias("open"),
                F.when(alone, F.array().cast("array<string>")).otherwise(F.concat(k["w"], part["w"])).alias("w"), F.when(alone, F.lit(0)).otherwise(n + k["n"]).alias("size"),
            )

        return let(kept, then)

    start = F.struct(none.alias("done"), F.lit("").alias("open"), F.array().cast("array<string>").alias("w"), F.lit(0).alias("size"))
    return F.aggregate(parts, start, step, lambda state: F.when(state["size"] > 0, F.concat(state["done"], chunk(state["open"], state["w"]))).otherwise(state["done"]))


def without_small(parts: Column, least: int = LEAST) -> Column:
    """The texts of chunks, those under half the least tokens joined to the one before, wherever they stand."""
    small = lambda c: tokens(c["n"]) < least // 2
    joined = lambda out, c: F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.concat(F.element_at(out, -1), F.lit(" "), c["c"])))
    return F.aggregate(parts, F.array().cast("array<string>"), lambda out, c: F.when((F.size(out) > 0) & small(c), joined(out, c)).otherwise(F.concat(out, F.array(c["c"]))))


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """array of strings; empty for a blank or null text."""
    return without_small(gathered(segments(F.coalesce(text, F.lit("")), most), most), least)


def chunk_sections(sections: Column, least: int = LEAST, most: int = MOST) -> Column:
    """From an array of (heading, level, text): array of (heading, chunk), each chunk with its heading in front."""
    front = lambda s: F.when(F.coalesce(s["heading"], F.lit("")) != "", F.concat(F.lit("["), s["heading"], F.lit("] "))).otherwise("")
    each = F.transform(sections, lambda s: F.transform(chunks(s["text"], least, most), lambda c: F.struct(s["heading"].alias("heading"), F.concat(front(s), c).alias("chunk"))))
    return F.flatten(F.coalesce(each, F.array().cast("array<array<struct<heading:string,chunk:string>>>")))


def with_chunks(items: DataFrame, body: str = "content_body", **sizes: int) -> DataFrame:
    """A row for each chunk, with chunk_index and chunk_text."""
    return items.select("*", F.posexplode_outer(chunks(F.col(body), **sizes)).alias("chunk_index", "chunk_text")).where("chunk_text IS NOT NULL")
