"""Every registered query against its SQL, and the shape of those without."""

import math

import duckdb
import pytest

from millrace.plans import record_queries, source_queries  # noqa: F401
from millrace.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, found.fetchall())


def test_pages_by_another_parser(spark):
    """Links, bodies and sections of the pages, against plain patterns on their few tags."""
    import html as entities
    import re

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    hrefs = {i: re.findall(r"<a\b[^>]*?\bhref=[\"']([^\"']+)[\"']", r["html"] or "") for i, r in pages.items()}
    links = {}
    for r in QUERIES["page_links"](spark, FOLDER).collect():
        links.setdefault(r["page"], set()).add(r["url"])
    for i, r in pages.items():
        plain_ones = {entities.unescape(h).partition("#")[0] for h in hrefs[i] if h.startswith("http")}
        assert plain_ones <= links.get(r["url"], set())
    squeeze = lambda t: " ".join(t.split())
    bodies = {r["page_id"]: r["body"] for r in QUERIES["html_bodies"](spark, FOLDER).collect()}
    assert bodies.keys() == pages.keys()
    for i, b in bodies.items():
        words = set(re.findall(r"\w+", entities.unescape(re.sub(r"<[^>]*>?", " ", pages[i]["html"] or ""))))
        assert b is None or (squeeze(b) == b and len(set(re.findall(r"\w+", b)) - words) <= 0.05 * len(words))
    assert sum(b is not None for b in bodies.values()) > 0.5 * len(bodies)
    for r in QUERIES["html_sections"](spark, FOLDER).collect():
        assert r["level"] in (0, 1, 2, 3) and r["text"] and (r["level"] > 0 or r["heading"] == "")


def test_stemmed_search(spark):
    """The best texts by stems, by the formula over plain lists."""
    from millrace.functions.stem import stem
    from millrace.operators import search
    from millrace.plans.queries import WANTED

    import re

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    lists = {i: [stem(w) for w in re.sub(r"[^\w]+", " ", t.lower()).split() if w not in search.STOP_WORDS] for i, t in docs.items()}
    mean, wanted = sum(map(len, lists.values())) / len(lists), [stem(w) for w in WANTED]
    df = {w: sum(w in x for x in lists.values()) for w in wanted}
    score = {i: sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * x.count(w) * 2.2 / (x.count(w) + 1.2 * (0.25 + 0.75 * len(x) / mean)) for w in wanted if w in x) for i, x in lists.items()}
    best = sorted(((round(s, 5), -i) for i, s in score.items() if s), reverse=True)[:10]
    assert [(round(r["score"], 5), -r["doc_id"]) for r in QUERIES["stemmed_topk"](spark, FOLDER).collect()] == best


def test_queries_without_sql():
    """Each of these is held to plain code: above, in test_operators (ann_topk) in test_indexes (graph_topk) or in test_language (document_languages)."""
    assert set(QUERIES) - set(ORACLES) == {"ann_topk", "document_languages", "graph_topk", "html_bodies", "html_sections", "page_links", "stemmed_topk"}


def test_hot_runs_make_no_pairs(spark):
    plan = QUERIES["fingerprint"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_filters_reach_the_scan(spark):
    plan = QUERIES["feed_newest"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan and "user_id" not in plan.split("ReadSchema:")[1]
