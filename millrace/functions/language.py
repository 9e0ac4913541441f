"""The language of a text by its three-character stretches.

A model has for each language a profile: how likely each stretch is there, by a hash of its three code points. A text is in
the language under which its stretches are likeliest. Profiles are fitted on a bounded sample of labelled texts; scores
are whole numbers added up by expressions, so no Python worker is started.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash bins of a profile; what a likelihood is multiplied by; labelled texts that a fit takes, and characters of each.
BINS, SCALE, SAMPLE, SAMPLE_CHARS = 4096, 1000, 2_000, 4_000
#: The language of a text that has no stretch of three characters, and of all texts for a model without languages.
DEFAULT = "en"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: tuple[tuple[int, ...], ...]


def bins(text: str) -> list[int]:
    """The bins of a text's stretches; blanks and all that is no letter count as one character, a space."""
    points = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()} "]
    return [((a * 31 + b) * 31 + c) % BINS for a, b, c in zip(points, points[1:], points[2:])]


def fit_rows(rows: Iterable[tuple[str | None, str | None]]) -> Model:
    """Profiles of (text, language) rows: logarithms of smoothed shares, in whole thousandths."""
    counts: dict[str, list[int]] = {}
    for text, language in rows:
        if text and language:
            own = counts.setdefault(language, [0] * BINS)
            for b in bins(text):
                own[b] += 1
    names = tuple(sorted(counts))
    share = lambda own: tuple(round(SCALE * math.log((n + 0.5) / (sum(own) + 0.5 * BINS))) for n in own)
    return Model(names, tuple(share(counts[n]) for n in names))


def fit(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Profiles from at most `sample` labelled rows, those with the least hashes of their ids, and SAMPLE_CHARS characters of each."""
    labelled = texts.where(F.col(text_col).isNotNull() & F.col(language_col).isNotNull())
    some = labelled.orderBy(F.xxhash64(id_col), id_col).limit(sample).select(F.substring(text_col, 1, SAMPLE_CHARS), language_col)
    return fit_rows(tuple(r) for r in some.collect())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def bins_of(text: Column) -> Column:
    """bins() as an expression."""
    letters = F.regexp_replace(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), r"[^\p{L}]", " ")

    def stretches(points: Column) -> Column:
        at = lambda i, k: F.element_at(points, (i + k).cast("int"))
        return F.transform(F.sequence(F.lit(1), F.size(points) - 2), lambda i: F.pmod((at(i, 0) * 31 + at(i, 1)) * 31 + at(i, 2), F.lit(BINS)).cast("int") + 1)

    points = F.transform(F.split(letters, ""), lambda c: F.ascii(c).cast("long"))
    return let(points, lambda p: F.when(F.size(p) > 2, let(p, stretches)).otherwise(F.array().cast("array<int>")))


def detect(text: Column, model: Model) -> Column:
    """The likeliest language of a text, of equally likely ones the first by name; DEFAULT where there is nothing to go by. A null text is an empty one."""
    if not model.languages:
        return F.lit(DEFAULT)

    def likeliest(found: Column) -> Column:
        def score(weights: tuple[int, ...]) -> Column:
            table = F.from_json(F.lit(json.dumps(weights)), "array<int>")  # folded into one constant
            return F.aggregate(found, F.lit(0).cast("long"), lambda s, b: s + F.element_at(table, b))

        ranked = F.array(*(F.struct((-score(w)).alias("cost"), F.lit(name).alias("name")) for name, w in zip(model.languages, model.weights)))
        return F.when(F.size(found) > 0, F.array_min(ranked)["name"]).otherwise(DEFAULT)

    return let(bins_of(F.coalesce(text, F.lit(""))), likeliest)


def with_language(items: DataFrame, model: Model, text_col: str = "content_body", column: str = "lang") -> DataFrame:
    """Items with their language where none is stated."""
    found = detect(F.col(text_col), model)
    return items.withColumn(column, F.coalesce(F.col(column), found) if column in items.columns else found)
