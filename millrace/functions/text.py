"""Texts and identifiers: cleaning, gates, hashes, evidence levels, harvested references, captions, embedding texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BOILERPLATE = ("we use cookies", "accept all cookies", "cookie preferences", "privacy preferences", "sign in to continue", "sign in to read", "log in to continue", "create an account", "subscribe to read", "subscribe to continue", "access denied", "please enable javascript")
PAYWALL = ("sign in", "log in", "create account", "access denied", "subscribe to read")
NO_CONTENT_TITLES = ("just a moment", "attention required", "403 forbidden", "404 not found", "access denied")
#: Evidence levels by words of title and description, in the order that decides.
EVIDENCE_WORDS = {
    "systematic_review": ("systematic review", "meta-analysis", "cochrane"),
    "rct": ("randomized controlled", "randomised controlled", "rct", "double-blind"),
    "cohort": ("cohort study", "longitudinal study", "prospective study"),
    "case_study": ("case study", "case report", "case series"),
    "expert_opinion": ("expert opinion", "editorial", "commentary", "perspective"),
    "guideline": ("clinical guideline", "practice guideline", "dsm-5", "icd-"),
}
EVIDENCE_OF_PLATFORM = {"biorxiv": "preprint", "clinicaltrials": "clinical_trial"}
GUIDANCE_PLATFORMS = ("html_pages", "browser_pages", "nhs_api")
DOI_RESOLVER = r"(?i)^https?://(dx\.)?doi\.org/"
# The forms of the identifiers, by kind of reference in running text, in the order in which they are looked for.
REFERENCES = {"doi": r"""doi\.org/(10\.[^\s">\]]+)""", "pmid": r"pubmed\.ncbi\.nlm\.nih\.gov/(\d{4,})", "arxiv": r"arxiv\.org/abs/([\w.]+)", "pmc": r"pmc\.ncbi\.nlm\.nih\.gov/PMC(\d+)"}
#: Prefixes that the embedding model expects.
DOCUMENT_PREFIX, QUERY_PREFIX = "search_document: ", "search_query: "
STALE_AFTER_DAYS, LEAST_BODY, FULL_TEXT = 5 * 365, 150, 1000


def has_any(text: Column, parts: Sequence[str]) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(low, p))


def strip_nul(text: Column) -> Column:
    return F.translate(text, "\0", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def squeeze(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def clean_text(html: Column) -> Column:
    """Without tags, white space squeezed; null for nothing."""
    return F.nullif(squeeze(F.regexp_replace(html, "<[^>]+>", "")), F.lit(""))


def normalize_title(title: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(title), r"(?U)[^\w\s]", ""))


def normalize_doi(doi: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(doi), DOI_RESOLVER, ""))


def content_hash(body: Column) -> Column:
    return F.when(body != "", F.sha2(body, 256))


def stored_body(body: Column) -> Column:
    """The body as stored: without NUL; null where it has under 150 characters (an empty one stays empty)."""
    clean = strip_nul(body)
    return F.when((clean == "") | (F.length(F.regexp_replace(clean, r"(?U)^\s+|\s+$", "")) >= LEAST_BODY), clean)


def passes_extraction(text: Column) -> Column:
    """Long enough to be an article: 300 characters and 50 words, and under 1000 characters no boilerplate."""
    return F.coalesce((F.length(text) >= 300) & (F.size(words(text)) >= 50) & ~(has_any(text, BOILERPLATE) & (F.length(text) < 1000)), F.lit(False))


def behind_paywall(body: Column) -> Column:
    return (F.length(body) < 300) | has_any(body, PAYWALL)


def is_no_content_title(title: Column) -> Column:
    return F.coalesce(has_any(title, NO_CONTENT_TITLES), F.lit(False))


def has_required(title: Column, url: Column) -> Column:
    return F.coalesce((F.trim(title) != "") & (url != ""), F.lit(False))


def language(text: Column) -> Column:
    """The default rule: what no detector has looked at is en."""
    return F.lit("en")


def is_stale(published: Column, as_of: Column) -> Column:
    return F.when(published.isNull(), None).otherwise(published < as_of - F.expr(f"INTERVAL {STALE_AFTER_DAYS} DAYS"))


def evidence_level(title: Column, description: Column, source_type: Column, platform: Column) -> Column:
    """The first rule that holds: informal sources, words in the text, the platform, the kind of source; else null."""
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))
    rule = F.when(source_type.isin("forum", "reddit", "social"), "anecdotal").when(source_type == "blog", "blog")
    for level, parts in EVIDENCE_WORDS.items():
        rule = rule.when(has_any(text, parts), level)
    for name, level in EVIDENCE_OF_PLATFORM.items():
        rule = rule.when(platform == name, level)
    rule = rule.when((source_type == "official_health") & platform.isin(*GUIDANCE_PLATFORMS), "government_guidance")
    for kind, level in (("hospital", "hospital_education"), ("academic", "peer_reviewed_study"), ("peer_reviewed", "peer_reviewed")):
        rule = rule.when(source_type == kind, level)
    return rule


def trim_unbalanced_paren(raw: Column) -> Column:
    """Up to the first closing parenthesis that nothing in the string opens."""
    depths = F.aggregate(
        F.split(raw, ""),
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end")),
        lambda s, c: F.struct(
            (s["depth"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("depth"),
            (s["at"] + F.length(c)).alias("at"),
            F.when((s["end"] < 0) & (c == ")") & (s["depth"] == 0), s["at"]).otherwise(s["end"]).alias("end"),
        ),
        lambda s: s["end"],
    )
    return F.when(depths >= 0, F.substr(raw, F.lit(1), depths)).otherwise(raw)


def references(text: Column) -> Column:
    """array of (kind, raw_id, stub_id, url, title): every reference in a text, by kind, then by place; the first of each stays."""
    url = {"doi": ("https://doi.org/", "", ""), "pmid": ("https://pubmed.ncbi.nlm.nih.gov/", "/", "PMID:"), "arxiv": ("https://arxiv.org/abs/", "", "arXiv:"), "pmc": ("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC", "/", "PMC")}
    lists = []
    for kind, pattern in REFERENCES.items():
        front, back, label = url[kind]

        def raw(m: Column, kind: str) -> Column:
            return F.regexp_replace(trim_unbalanced_paren(m), "[.,;:]+$", "") if kind == "doi" else F.regexp_replace(m, "[.,;:)]+$", "")

        def stub(kind: str, front: str, back: str, label: str):
            return lambda m: F.struct(F.lit(kind).alias("kind"), raw(m, kind).alias("raw_id"), F.concat(F.lit(f"{kind}:"), raw(m, kind)).alias("stub_id"), F.concat(F.lit(front), raw(m, kind), F.lit(back)).alias("url"), F.concat(F.lit(label), raw(m, kind)).alias("title"))

        lists.append(F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), stub(kind, front, back, label)))
    return F.array_distinct(F.concat(*lists))


def caption_lines(srt: Column) -> Column:
    """The spoken lines of an SRT text in order: no numbers, no times, no tags, no line that repeats the one before."""
    lines = F.transform(F.split(srt, r"\r?\n"), lambda x: F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), r"(?U)^\s+|\s+$", ""))
    spoken = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^\d+$") & ~x.rlike(r"\d{2}:\d{2}:\d{2}[,.]\d{3}\s*-->"))
    # each line beside the one before it; a lambda that looked into the list would make it anew for every line
    beside = F.zip_with(spoken, F.concat(F.array(F.lit(None).cast("string")), spoken), lambda x, y: F.struct(x.alias("line"), y.alias("before")))
    return F.transform(F.filter(beside, lambda p: p["line"].isNotNull() & ~p["line"].eqNullSafe(p["before"])), lambda p: p["line"])


def srt_to_text(srt: Column) -> Column:
    return F.array_join(caption_lines(srt), " ")


def estimate_tokens(text: Column) -> Column:
    return F.floor(4 * F.size(words(text)) / 3).cast("int")


def overlap_prefix(text: Column, share: float = 0.15) -> Column:
    """The last words of a text, at least one."""
    w = words(text)
    k = F.greatest(F.lit(1), F.floor(F.size(w) * share).cast("int"))
    return F.when(F.size(w) > 0, F.array_join(F.slice(w, F.greatest(F.lit(1), F.size(w) - k + 1), k), " ")).otherwise("")


def summary_text(title: Column, body: Column) -> Column:
    return F.trim(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(F.coalesce(body, F.lit("")), 1, 500)))


def embed_text(title: Column, description: Column, body: Column) -> Column:
    """Title and the first 800 characters of the body, or of the description the first 500."""
    rest = F.when(F.coalesce(body, F.lit("")) != "", F.substring(body, 1, 800)).otherwise(F.substring(F.coalesce(description, F.lit("")), 1, 500))
    return F.trim(F.concat(F.trim(F.coalesce(title, F.lit(""))), F.lit(" "), F.trim(rest)))


def as_document(text: Column) -> Column:
    return F.concat(F.lit(DOCUMENT_PREFIX), text)


def as_query(text: Column) -> Column:
    return F.concat(F.lit(QUERY_PREFIX), text)


def truncated(text: Column, most: int = 80) -> Column:
    """At most so many characters, with an ellipsis where something is cut."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def title_from_pdf(text: Column, url: Column) -> Column:
    """The first line if it can be a title, else the file's name in words, else the URL."""
    first = F.regexp_replace(F.split_part(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""), F.lit("\n"), F.lit(1)), r"(?U)^\s+|\s+$", "")
    name = F.regexp_extract(F.regexp_extract(url, r"^(?:[a-z]+:)?//[^/?#]*([^?#]*)", 1), "([^/]*)$", 1)
    stem = F.trim(F.regexp_replace(F.regexp_replace(name, r"(?i)\.pdf$", ""), r"[_\-]+", " "))
    return F.when(F.length(first).between(8, 200), first).when(stem != "", stem).otherwise(url)


def pdf_text(pages: Column) -> Column:
    """Text of a PDF from the text of its pages: no lines of digits, nothing from the list of references on, squeezed; empty for no text."""
    joined = F.array_join(F.transform(pages, lambda p: F.coalesce(p, F.lit(""))), "\n")
    kept = F.array_join(F.filter(F.split(joined, "\n"), lambda x: ~F.trim(x).rlike(r"^\d+$")), "\n")
    cut = F.split(kept, r"(?i)\nReferences\s*\n", 2)[0]
    return F.when(pages.isNull(), None).otherwise(squeeze(cut))


def rate_per_second(limit: Column, interval: Column) -> Column:
    """Requests a second from two headers such as 50 and 1s; null for what isn't one."""
    pattern = r"^\s*(\d+)\s*([smh]?)\s*$"
    unit = F.regexp_extract(interval, pattern, 2)
    seconds = F.nullif(F.regexp_extract(interval, pattern, 1), F.lit("")).try_cast("double") * F.when(unit == "h", 3600).when(unit == "m", 60).otherwise(1)
    return F.when(seconds > 0, limit.try_cast("double") / seconds)


def backoff_seconds(attempt: Column, base: float = 1.0, cap: float = 60.0) -> Column:
    """Without jitter: the base doubled for each attempt, up to the cap."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(cap))


def startup_delay(last_run: Column, now: Column, interval_s: int) -> Column:
    elapsed = F.unix_micros(now.cast("timestamp")) / 1e6 - F.unix_micros(last_run.cast("timestamp")) / 1e6
    return F.when(last_run.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.lit(float(interval_s)) - elapsed))


def percent(n: Column, total: Column) -> Column:
    return F.when(total == 0, "─").otherwise(F.concat(F.format_string("%.0f", F.rint(n / total * 100)), F.lit("%")))


def bar(n: Column, total: Column, width: int = 20) -> Column:
    """A bar of characters."""
    filled = F.rint(n / total * width).cast("int")
    return F.when(total == 0, "[" + "-" * width + "]").otherwise(F.concat(F.lit("["), F.repeat(F.lit("█"), filled), F.repeat(F.lit("─"), F.lit(width) - filled), F.lit("]")))
