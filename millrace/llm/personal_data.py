"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust their scores.

Everything is a Spark expression over the row of the text: no shuffle, no Python. A pattern is run twice, once for its
matches and once for what stands between them; their lengths give the places. Patterns are written so that Java's
matcher never looks at a character more than a few times: possessive repetitions, and a beginning that is tried only
where a run of the pattern's first characters begins (or where the last match has ended, `\\G`).

Base kinds are kept whatever their score. The method adds `iban` (mod-97 over the length of its country) and `ssn`, which
has no checksum and stands only if a word near it says what it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import text_of

#: Code points before and after a span in which words count.
BEFORE, AFTER = 48, 24
#: Matches whose places are summed up together; sums of blocks are added first, so work doesn't grow with the square.
BLOCK = 128
#: Spans of added kinds need this score, of 100.
LEAST = 50

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Lengths of account numbers by country (ISO 13616).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}


@dataclass(frozen=True)
class Kind:
    """sign: a character or pattern without which no text has a match; pattern for Java, plain for engines without
    lookbehind (the same matches); raised and lowered: words by which a score of `score` changes."""

    name: str
    sign: str
    pattern: str
    plain: str
    score: int
    raised: str
    lowered: str


EMAIL_PART, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = (
    Kind("email", "@", rf"(?:\G|(?<!{EMAIL_PART})){EMAIL_PART}++@{LABEL}++(?:\.{LABEL}++)++", rf"{EMAIL_PART}+@{LABEL}+(?:\.{LABEL}+)+", 80, "mail|email|e-mail|contact|write|mailto", "example|noreply"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]+(?:\.[0-9]+){3}", 50, "ip|address|host|server|login|client|from", "version|release|section|chapter|build"),
    Kind("card", "[0-9][ -]?[0-9]", "[0-9](?:[ -]?[0-9])++", "[0-9](?:[ -]?[0-9])+", 60, "card|visa|mastercard|amex|credit|debit|payment|cvv|cvc", "isbn|order|invoice|tracking|serial"),
    Kind("phone", "+", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 60, "phone|tel|telephone|call|mobile|fax|whatsapp|contact", "score|total|offset"),
    Kind("iban", "[A-Z]{2}[0-9]{2}", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", 80, "iban|account|bank|transfer|bic|swift", "example|sample"),
    Kind("ssn", "[0-9]-[0-9]{2}-[0-9]", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 30, "ssn|social|security|taxpayer", "order|part|phone|tel"),
)
BASE = tuple(k.name for k in KINDS[:4])
CHANGE = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def words_pattern(words: str) -> str:
    return f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn_holds(digits: Column) -> Column:
    """Luhn's check over a string of digits."""

    def add(total, place):
        d = F.substring(digits, F.length(digits) - place + F.lit(1), F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(place % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97_holds(account: Column) -> Column:
    """The remainder by 97 of an account number without spaces, its first four characters moved to its end and letters
    read as 10 to 35, is 1."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def add(rest, place):
        c = F.substring(turned, place, F.lit(1))
        value = F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (rest * F.when(c >= "A", F.lit(100)).otherwise(F.lit(10)) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def holds(kind: str, match: Column, last: Column, following: Column) -> Column:
    """Whether a match (trimmed, for iban) is one of its kind; last and following are the characters beside it."""
    if kind == "ip":
        bare = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(bare, lambda p: (F.length(p) < 3) | (F.length(p) == 3) & (p <= "255"))
    if kind == "card":
        return let(digits_of(match), lambda d: F.when(F.length(d).between(14, 19), luhn_holds(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits_of(match)).between(10, 15)
    if kind == "iban":
        alone = ~last.rlike("[A-Za-z0-9]")
        return alone & let(F.replace(match, F.lit(" "), F.lit("")), lambda a: (F.length(a) > 4) & mod97_holds(a))
    if kind == "ssn":
        parts = ~(match.rlike("^(?:000|666|9)") | match.rlike("^...-00") | match.rlike("0000$"))
        return parts & ~last.rlike("[0-9-]") & ~following.rlike("[0-9-]")
    return F.lit(True)


def trimmed(kind: str, match: Column) -> Column:
    """For iban, as many characters of the match as an account number of its country has; '' for no country."""
    if kind != "iban":
        return match
    lengths = F.create_map(*(F.lit(x) for kv in IBAN_LENGTHS.items() for x in kv))
    size = F.coalesce(lengths[F.substring(match, 1, 2)], F.lit(0))
    pattern = F.concat(F.lit("^(?:[A-Z0-9] ?){"), (size - 1).cast("string"), F.lit("}[A-Z0-9]"))
    return F.when(size > 0, F.coalesce(F.regexp_substr(match, pattern), F.lit(""))).otherwise("")


def candidates(text: Column, kind: Kind) -> Column:
    """All matches: gap (code points since the last one), n (its own), size (what of it counts), score (null: not of its kind)."""
    both = F.struct(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"), F.split(text, kind.pattern, -1).alias("pieces"))

    def of(b):
        def one(match, i):
            before = F.concat(F.coalesce(F.get(b["found"], i - 1), F.lit("")), F.right(b["pieces"][i], F.lit(BEFORE)))
            after = F.concat(F.left(b["pieces"][i + 1], F.lit(AFTER)), F.left(F.coalesce(F.get(b["found"], i + 1), F.lit("")), F.lit(AFTER)))
            near = lambda: F.translate(F.concat(F.right(before, F.lit(BEFORE)), F.lit("|"), F.left(after, F.lit(AFTER))), UPPER, LOWER)
            change = lambda words, by, x: F.when(x.rlike(words_pattern(words)), F.lit(by)).otherwise(F.lit(0))
            score = let(near(), lambda x: F.lit(kind.score) + change(kind.raised, min(CHANGE, 100 - kind.score), x) + change(kind.lowered, -CHANGE, x))
            if kind.name not in BASE:
                score = let(score, lambda s: F.when(s >= LEAST, s))
            good = lambda m: holds(kind.name, m, F.right(before, F.lit(1)), F.left(after, F.lit(1)))
            return let(trimmed(kind.name, match), lambda m: F.struct(
                F.length(b["pieces"][i]).cast("long").alias("gap"), F.length(match).cast("long").alias("n"),
                F.length(m).cast("long").alias("size"), F.when(good(m), score).alias("score"),
            ))

        return F.transform(b["found"], one)

    return let(both, of)


SPAN = "start:long,rank:int,end:long,kind:string,score:int"


def located(text: Column, rank: int) -> Column:
    """start, rank, end, kind, score of the matches of KINDS[rank] that hold, in order of their places."""
    empty = F.array().cast(f"array<struct<{SPAN}>>")

    def of(all_):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(all_) > 0, let(blocks, placed)).otherwise(empty)

    def placed(blocks):
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("starts"))
        length = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda s, x: s + x["gap"] + x["n"])
        starts = F.aggregate(blocks, zero, lambda a, block: F.struct((a["at"] + length(block)).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts")), lambda a: a["starts"])

        def within(starts):
            return F.flatten(F.transform(blocks, lambda block, i: F.aggregate(block, F.struct(starts[i].alias("at"), empty.alias("spans")), add, lambda a: a["spans"])))

        return let(starts, within)

    def add(a, x):
        start = a["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["size"]).alias("end"), F.lit(KINDS[rank].name).alias("kind"), x["score"].alias("score"))
        return F.struct((start + x["n"]).alias("at"), F.when(x["score"].isNotNull(), F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    sign = KINDS[rank].sign
    signed = text.contains(sign) if len(sign) == 1 else text.rlike(sign)
    return F.when(signed, let(candidates(text, KINDS[rank]), of)).otherwise(empty)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, spans (array of kind, start, end, score; code points, end exclusive; by start, then by kind as listed in KINDS)
    for every row of docs.

    Scores are of 100 and never remove a span of a base kind. A null text is an empty one and has no spans. A null id
    stays null; repeated rows give repeated results; other columns are not read, whatever their names; an empty table
    gives an empty result. Whole texts are read, in time that grows with their length.
    """
    read = text_of(docs, id_col, text_col).select(F.col(id_col), F.col(text_col).alias("text_"))
    found = F.sort_array(F.concat(*(located(F.col("text_"), rank) for rank in range(len(KINDS)))))
    spans = F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return read.select(F.col(id_col), spans.alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, a digest of the base spans, and all spans with their scores as text."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    counts = (F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE)
    scores = F.concat_ws(",", F.transform("spans", lambda s: s["score"].cast("string")))
    return found.select(id_col, *counts, F.sha2(text(of(*BASE)), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), scores.alias("scores"))


def oracle() -> str:
    """The same rows by DuckDB: matches of each pattern numbered, places by running sums, checks over lists of characters."""
    lengths = ", ".join(f"'{k}': {v}" for k, v in IBAN_LENGTHS.items())
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = "(SELECT sum(CASE WHEN p % 2 = 1 THEN d WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END) FROM (SELECT p, substr(reverse(digits), p::INT, 1)::INT AS d FROM unnest(range(1, length(digits) + 1)) t(p))) % 10 = 0"
    turned = "string_split(substr(account, 5) || left(account, 4), '')"
    codes = f"list_transform({turned}, lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)"
    mod97 = f"list_reduce(list_prepend(0, {codes}), lambda s, c: (s * CASE WHEN c > 9 THEN 100 ELSE 10 END + c) % 97) = 1"
    checks = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda p: length(regexp_replace(p, '^0+', '')) > 3 OR (length(regexp_replace(p, '^0+', '')) = 3 AND regexp_replace(p, '^0+', '') > '255'))) = 0",
        "card": f"length(digits) BETWEEN 14 AND 19 AND {luhn}",
        "phone": "length(digits) BETWEEN 10 AND 15",
        "iban": f"NOT regexp_matches(last, '[A-Za-z0-9]') AND length(account) > 4 AND {mod97}",
        "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|^...-00|0000$') AND NOT regexp_matches(last, '[0-9-]') AND NOT regexp_matches(following, '[0-9-]')",
    }
    parts = []
    for rank, k in enumerate(KINDS):
        size = f"^(?:[A-Z0-9] ?){{' || (coalesce(MAP {{{lengths}}}[left(m, 2)], 99) - 1)::VARCHAR || '}}[A-Z0-9]"
        own = f"regexp_extract(m, '{size}')" if k.name == "iban" else "m"
        change = lambda words, by: f"CASE WHEN regexp_matches(near, '{words_pattern(words)}') THEN {by} ELSE 0 END"
        parts.append(f"""
SELECT r, doc_id, {rank} AS rank, '{k.name}' AS kind, start, start + length(own) AS stop, score FROM (
  SELECT *, {k.score} + {change(k.raised, min(CHANGE, 100 - k.score))} + {change(k.lowered, -CHANGE)} AS score FROM (
    SELECT *, {digits.replace("(m,", "(own,")} AS digits, replace(own, ' ', '') AS account, right(before, 1) AS last, left(after, 1) AS following,
      translate(right(before, {BEFORE}) || '|' || left(after, {AFTER}), '{UPPER}', '{LOWER}') AS near FROM (
      SELECT r, doc_id, m, {own} AS own, coalesce(previous, '') || right(piece, {BEFORE}) AS before, left(following_piece, {AFTER}) || coalesce(following_match, '') AS after,
        (sum(length(piece) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m))::BIGINT AS start FROM (
        SELECT r, doc_id, i, found[i] AS m, pieces[i] AS piece, pieces[i + 1] AS following_piece, found[i - 1] AS previous, found[i + 1] AS following_match FROM (
          SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
            SELECT r, doc_id, regexp_extract_all(text, '{k.plain}') AS found, string_split_regex(text, '{k.plain}') AS pieces FROM docs))))))
WHERE {checks[k.name].replace("(m,", "(own,")}{"" if k.name in BASE else f" AND score >= {LEAST}"}""")
    base = ", ".join(f"'{b}'" for b in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{b}') AS n_{b}" for b in BASE)
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank){}, '')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), spans AS ({" UNION ALL ".join(parts)})
SELECT docs.doc_id, {counts}, sha256({joined.format(f" FILTER (kind IN ({base}))")}) AS base_sha256,
  {joined.format("")} AS spans, coalesce(string_agg(score::VARCHAR, ',' ORDER BY start, rank), '') AS scores
FROM docs LEFT JOIN spans USING (r) GROUP BY r, docs.doc_id"""
