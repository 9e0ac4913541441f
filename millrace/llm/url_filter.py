"""URL filters: host rules, and beyond them logistic regression on hashed character n-grams of host and path.

Everything on the data is DataFrame expressions. The model is fitted on the driver from a small labelled table of
invented hosts, labelled_urls.csv beside this file (url, block); a fifth of the hosts is held out of the fit. Its weights
are whole millionths, so that sums are exact in any order and on any engine.
"""

from __future__ import annotations

import csv
import json
import math
import zlib
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, SIZES, SCALE = 4093, (3, 4), 1_000_000
#: (verdict, domain, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def labelled_urls(held_out: bool | None = None) -> list[tuple[str, int]]:
    """(url, 1 to block) of the labelled table: those of the hosts that are held out (crc32 modulo 5 is 0), of the others, or all."""
    with Path(__file__).with_name("labelled_urls.csv").open(encoding="utf-8", newline="") as f:
        rows = [(r["url"], int(r["block"])) for r in csv.DictReader(f)]
    return [r for r in rows if held_out is None or (zlib.crc32(r[0].split("/")[2].encode()) % 5 == 0) == held_out]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(text: str) -> list[int]:
    """The buckets of a text's n-grams: a polynomial in the code points."""
    c = [ord(x) for x in f"^^{text}$$"]
    out = []
    for n in SIZES:
        for i in range(len(c) - n + 1):
            h = n
            for x in c[i : i + n]:
                h = h * 31 + x
            out.append(h % BUCKETS)
    return out


def train(rows: list[tuple[str, int]], rounds: int = 200, rate: float = 0.5, ridge: float = 1e-4, most_rows: int = 100_000) -> tuple[int, list[int]]:
    """Intercept and weights in millionths, by gradient descent on the mean logistic loss. rows: (url, 1 to block); more than most_rows is an error."""
    if len(rows) > most_rows:
        raise ValueError(f"the labelled table has more than {most_rows} rows")
    import re

    items = []
    for url, label in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        g = grams(m[1].translate(str.maketrans(UPPER, LOWER)) + m[2] if m else "")
        items.append((g, 1 / math.sqrt(len(g)), label))
    weight, bias = [0.0] * BUCKETS, 0.0
    for _ in range(rounds if items else 0):
        slope, at = {}, 0.0
        for g, unit, label in items:
            z = bias + unit * sum(weight[b] for b in g)
            e = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - label
            at += e
            for b in g:
                slope[b] = slope.get(b, 0.0) + e * unit
        step = rate / len(items)
        for b, s in slope.items():
            weight[b] -= 20 * step * s + ridge * weight[b]
        bias -= step * at
    return round(SCALE * bias), [round(SCALE * w) for w in weight]


def codes_of(text: Column) -> Column:
    """The code points of a text between its marks."""
    marked = F.concat(F.lit("^^"), text, F.lit("$$"))
    return F.transform(F.split(marked, ""), lambda c: F.ascii(c).cast("long"))  # one pass: a place in a string is found from its beginning


def gram_sum(codes: Column, n: int, weights: Column) -> Column:
    """The weights of all n-grams, added up."""

    def weight(i: Column) -> Column:
        h = F.lit(n).cast("long")
        for k in range(n):
            h = h * 31 + F.element_at(codes, (i + k).cast("int"))
        return F.element_at(weights, (F.pmod(h, F.lit(BUCKETS)) + 1).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.size(codes) - (n - 1)), F.lit(0).cast("long"), lambda a, i: a + weight(i))


def log_odds(codes: Column, model: tuple[int, list[int]]) -> Column:
    """The model's log odds to block, for the code points of host and path in one string."""
    bias, weights = model
    table = F.from_json(F.lit(json.dumps(weights)), "array<bigint>")  # folded into one constant
    total = sum((gram_sum(codes, n, table) for n in SIZES[1:]), gram_sum(codes, SIZES[0], table))
    return (F.lit(bias).cast("double") + total.cast("double") / F.sqrt((2 * F.size(codes) - (sum(SIZES) - 2)).cast("double"))) / SCALE


def rule_text(rule: tuple[str, str, str]) -> str:
    return rule[1] + rule[2]


def judge_urls(pages: DataFrame, model: tuple[int, list[int]], rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, score for every row of pages.

    Of the rules that fit, the longest decides; else the model, which blocks at log odds of 0 or more. score is the
    model's probability to block, to six places. A null url, or one without ://, has empty host and path and no rule.
    A null id stays null; repeated rows give repeated results; other columns are not read, whatever their names; an
    empty table gives an empty result. Whole URLs are judged, however long.
    """
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = F, F
    for name, domain, prefix in sorted(rules, key=lambda r: -len(rule_text(r))):
        fits = ((F.col("host") == domain) | F.endswith("host", F.lit(f".{domain}"))) & F.startswith("path", F.lit(prefix))
        rule, verdict = rule.when(fits, F.lit(domain + prefix)), verdict.when(fits, F.lit(name))
    scored = parts.withColumn("codes", codes_of(F.concat("host", "path"))).withColumn("z", log_odds(F.col("codes"), model))
    score = F.round(1 / (1 + F.exp(-F.col("z"))), 6)
    return scored.select(id_col, "host", "path", (F.lit(None).cast("string") if rule is F else rule).alias("rule"), (F if verdict is F else verdict).when(F.col("z") >= 0, "block").otherwise("allow").alias("verdict"), score.alias("score"))


def oracle(model: tuple[int, list[int]], rules=RULES) -> str:
    """The same as DuckDB SQL."""
    bias, weights = model
    cases = sorted(rules, key=lambda r: -len(rule_text(r)))
    fits = lambda r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
    gram = lambda n: "list_sum(list_transform(range(1, len(codes) - %d), lambda i: w[(%s) %% %d + 1]))" % (n - 2, _horner(n), BUCKETS)
    return f"""
WITH model AS (SELECT {weights}::BIGINT[] AS w),
parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
coded AS (SELECT *, list_transform(range(1, length('^^' || host || path || '$$') + 1), lambda i: unicode(substring('^^' || host || path || '$$', i, 1))::BIGINT) AS codes FROM parts),
scored AS (SELECT page_id, host, path, ({bias}::DOUBLE + ({' + '.join(gram(n) for n in SIZES)})::DOUBLE / sqrt((2 * len(codes) - {sum(SIZES) - 2})::DOUBLE)) / {SCALE} AS z FROM coded, model)
SELECT page_id, host, path, CASE {' '.join(f"WHEN {fits(r)} THEN '{rule_text(r)}'" for r in cases)} END AS rule,
CASE {' '.join(f"WHEN {fits(r)} THEN '{r[0]}'" for r in cases)} WHEN z >= 0 THEN 'block' ELSE 'allow' END AS verdict, round(1 / (1 + exp(-z)), 6) AS score FROM scored"""


def _horner(n: int) -> str:
    h = str(n)
    for k in range(n):
        h = f"({h} * 31 + codes[i + {k}])"
    return h
