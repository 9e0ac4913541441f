"""Merges, queues, state, sources, sinks and streams on small tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import merge, search, state
from millrace.sources import cursors, frontier, payloads, sinks
from millrace.streaming import ingest

ITEM = schemas.ITEMS


def items(spark, *rows):
    return schemas.conform(spark.createDataFrame([json.dumps(r) for r in rows] or ["{}"], "string").select(F.from_json("value", ITEM).alias("x")).select("x.*"), ITEM) if rows else spark.createDataFrame([], ITEM)


def test_policies(spark):
    old = items(spark, {"url": "u", "title": "old", "description": "d", "content_body": "body", "domain_tags": ["b"], "oa_url": "kept", "embedding": [1.0]})
    new = spark.createDataFrame([(1, "u", "new", None, None, ["a"]), (0, "v", "first", "x", "y", None), (2, "v", "second", None, None, None)], "seq int, url string, title string, description string, content_body string, domain_tags array<string>")
    got = {r["url"]: r for r in merge.merge_items(old, new).collect()}
    u, v = got["u"], got["v"]
    assert (u["title"], u["description"], u["content_body"], u["domain_tags"], u["oa_url"], u["needs_rechunk"]) == ("old", None, "body", ["a", "b"], "kept", False)
    assert (v["title"], v["description"], v["content_body"]) == ("first", None, "y")
    again = merge.merge_items(merge.merge_items(old, new), new)
    assert sorted(map(str, again.collect())) == sorted(map(str, merge.merge_items(old, new).collect()))
    changed = merge.merge_items(old, spark.createDataFrame([(0, "u", "t", "other")], "seq int, url string, title string, content_body string")).first()
    assert changed["needs_rechunk"] and changed["embedding"] is None


def test_empty_snapshot(spark):
    assert merge.merge_items(items(spark), spark.createDataFrame([(0, "u", "t")], "seq int, url string, title string")).count() == 1


SEARCH = {
    "reddit": {"data": {"children": [{"data": {"title": "T", "permalink": "/r/x", "created_utc": 0, "score": 3}}, {"data": {"title": " "}}], "after": "t3"}},
    "openalex": {"results": [{"id": "W1", "title": "T", "doi": "https://doi.org/10.1/A", "publication_date": "2020-01-02", "authorships": [{"author": {"display_name": "Ann B. Lee"}}], "abstract_inverted_index": {"b": [1], "a": [0]}, "open_access": {"is_oa": True}}]},
    "crossref": {"message": {"items": [{"title": ["T"], "DOI": "10.1/A", "published": {"date-parts": [[2020, 3]]}, "license": [{"URL": "https://creativecommons.org/by"}]}]}},
    "europepmc": {"resultList": {"result": [{"title": "T", "pmid": "5", "pubYear": "2019", "isOpenAccess": "Y"}]}},
    "semanticscholar": {"data": [{"paperId": "p", "title": "T", "url": "u", "year": 2018, "abstract": "Abstract not available", "authors": [{"name": "Plato"}]}]},
    "doaj": {"results": [{"id": "d1", "bibjson": {"title": "T", "identifier": [{"type": "doi", "id": "10.1/x"}], "year": "2017"}}]},
    "clinicaltrials": {"studies": [{"protocolSection": {"identificationModule": {"nctId": "N1", "briefTitle": "T"}, "descriptionModule": {"detailedDescription": "D"}}}]},
    "core": {"results": [{"id": 9, "title": "T", "fullText": "x" * 199}]},
    "hackernews": {"hits": [{"title": "T", "objectID": "7", "points": 9}, {"title": "low", "objectID": "8", "points": 1}]},
    "newsapi": {"status": "ok", "articles": [{"title": "T", "url": "u"}, {"title": "[Removed]", "url": "v"}]},
    "biorxiv": {"collection": [{"title": "T general", "doi": "10.1/b", "authors": "Lee, A; B", "date": "2021-05-06"}, {"title": "other", "doi": "10.1/c"}]},
}
WANT = {"reddit": "https://www.reddit.com/r/x", "openalex": "https://doi.org/10.1/a", "crossref": "https://doi.org/10.1/a", "europepmc": "https://europepmc.org/article/MED/5", "semanticscholar": "u", "doaj": "https://doi.org/10.1/x", "clinicaltrials": "https://clinicaltrials.gov/study/N1", "core": "https://core.ac.uk/works/9", "hackernews": "https://news.ycombinator.com/item?id=7", "newsapi": "u", "biorxiv": "https://doi.org/10.1/b"}


@pytest.mark.parametrize("platform", sorted(SEARCH))
def test_payloads(spark, platform):
    rows = spark.createDataFrame([(json.dumps(SEARCH[platform]), '{"query": "general"}'), ("not json", None), (None, None)], "body string, config string")
    got = payloads.read(platform, rows).collect()
    assert [(r["url"], r["title"][0], r["source"]) for r in got] == [(WANT[platform], "T", platform)]
    if platform == "openalex":
        assert (got[0]["description"], got[0]["author"], got[0]["doi"]) == ("a b", "Lee", "10.1/a")
    if platform in ("semanticscholar", "core"):
        assert got[0]["description"] is None and got[0]["content_body"] is None
    if platform == "crossref":
        assert got[0]["open_access"] is True and got[0]["published_at"] == dt.datetime(2020, 3, 1)


def test_xml_payloads(spark):
    feed = "<rss><channel><title>F</title><item><title>T</title><link>u</link><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate><description>&lt;b&gt;d&lt;/b&gt;</description></item></channel></rss>"
    got = payloads.rss(spark.createDataFrame([(feed,)], "body string")).first()
    assert (got["title"], got["url"], got["description"], got["journal"]) == ("T", "u", "d", "F")
    article = "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><Journal><Title>J</Title></Journal><ArticleTitle>A <i>b</i></ArticleTitle><Abstract><AbstractText>x</AbstractText><AbstractText>y</AbstractText></Abstract><AuthorList><Author><LastName>Lee</LastName><ForeName>Ann</ForeName></Author></AuthorList></Article><DateCompleted/><PubDate><Year>2020</Year><Month>Feb</Month></PubDate></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"doi\">10.1/Z</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"
    got = payloads.pubmed(spark.createDataFrame([(article,)], "body string")).first()
    assert (got["title"], got["url"], got["description"], got["author"], got["doi"], got["journal"], got["published_at"]) == ("A b", "https://pubmed.ncbi.nlm.nih.gov/7/", "x y", "Lee", "10.1/z", "J", dt.datetime(2020, 2, 1))


def test_other_sources(spark):
    hits = spark.createDataFrame([(json.dumps({"items": [{"id": {"videoId": "a"}, "snippet": {"title": "T"}}, {"id": {"videoId": "b"}, "snippet": {"title": "U"}}]}), '{"min_views": 5}')], "body string, config string")
    got = payloads.youtube(hits, spark.createDataFrame([("a", 9)], "id string, view_count long"), spark.createDataFrame([("a", "said")], "id string, text string")).collect()
    assert [(r["url"], r["content_body"]) for r in got] == [("https://www.youtube.com/watch?v=a", "said")]
    wiki = spark.createDataFrame([('{"type": "standard", "title": "T", "pageid": 1}', '{"title": "A b"}', "x" * 301), ('{"type": "disambiguation", "title": "U"}', '{"title": "U"}', None)], "body string, config string, extract string")
    assert [(r["url"], len(r["content_body"])) for r in payloads.wikipedia(wiki).collect()] == [("https://en.wikipedia.org/wiki/A_b", 301)]
    page = "<html><head><title>T - NHS</title></head><body><h1>Sleep - NHS</h1><p>Page last reviewed: 5 March 2024</p></body></html>"
    got = payloads.nhs_api(spark.createDataFrame([("https://www.nhs.uk/a/b/", page)], "url string, body string")).first()
    assert (got["title"], got["external_id"], got["published_at"]) == ("Sleep", "a/b", dt.datetime(2024, 3, 5))
    data = spark.createDataFrame([('{"id": "d", "name": "N", "viewCount": 3}', '[{"a": "1", "b": "2"}]')], "body string, rows string")
    assert payloads.cdc_data(data).first()["content_body"] == "Dataset: N\n\na: 1, b: 2"
    maps = spark.createDataFrame([("<urlset><url><loc>https://a/x/1</loc></url><url><loc> https://a/y </loc></url></urlset>",), ("<sitemapindex><sitemap><loc>https://a/s.xml</loc></sitemap></sitemapindex>",)], "body string")
    assert sorted((r["url"], r["kind"]) for r in payloads.sitemap_urls(maps, "/x").collect()) == [("https://a/s.xml", "sitemap"), ("https://a/x/1", "page")]
    blocked = spark.createDataFrame([("https://a/1", "<title>Just a moment...</title><body>x</body>"), ("https://a/2", "<title>Fine</title><body>x</body>")], "url string, body string")
    assert [r["title"] for r in payloads.browser_pages(blocked).collect()] == ["Fine"]
    with pytest.raises(ValueError):
        payloads.read("nothing", blocked)
    assert len(payloads.READERS) == 22


def test_cursors():
    assert cursors.offset("10", 5, 20) == "15" and cursors.offset("15", 5, 20) is None
    assert cursors.mark("*", "*") is None and cursors.mark(None, "x") == "x"
    assert cursors.page(None, 10, 10, 25) == "2" and cursors.page("3", 5, 10, 25) is None
    assert cursors.before(["c", "b", "a"], "b") == ["c"] and cursors.after(["a", "b", "c"], "b") == ["c"] and cursors.after(["a"], "z") == ["a"]
    assert cursors.newest("2024-01-02", ["2024-01-01", None]) == "2024-01-02"
    assert cursors.date_offset(None, "2024-01-01", 5, 9) == "2024-01-01/5" and cursors.date_offset("2024-01-01/5", "", 4, 9) is None
    assert cursors.last_id([3, 7], 2) == "7" and cursors.last_id([3], 2) is None and cursors.page_of(None, 1) is None


def test_frontier(spark):
    pages = spark.createDataFrame([("https://a.org/s/start", '<a href="/s/one">1</a><a href="/donate/x">d</a><a href="https://b.org/x/y">b</a><a href="/s/one#f">again</a><a href="/s/known">k</a>'), ("https://a.org/s/one", '<a href="two">2</a>')], "url string, body string")
    got = frontier.frontier(spark, frontier.links(pages), ["https://a.org/s/start"], spark.createDataFrame([("https://a.org/s/known",)], "url string"), "a.org", depth=2)
    assert sorted((r["url"], r["level"]) for r in got.collect()) == [("https://a.org/s/one", 1), ("https://a.org/s/two", 2)]


def test_snapshots_and_catalog(spark, tmp_path):
    store = sinks.Snapshots(spark, f"{tmp_path}/t")
    one = spark.createDataFrame([(1,)], "x int")
    assert store.read(one.schema).count() == 0
    assert store.write(one, 0) and not store.write(one, 0) and store.write(one.union(one), 1)
    assert store.read(one.schema).count() == 2
    entry = lambda key, host, tier=1: (key, "html_pages", 1, tier, json.dumps({"base_url": f"https://{host}"}))
    kind = "key string, platform string, enabled int, authority_tier int, config string"
    have = schemas.conform(spark.createDataFrame([entry("a", "x.org")], kind), schemas.CATALOG)
    sinks.Snapshots(spark, f"{tmp_path}/c").write(have, 0)
    new = schemas.conform(spark.createDataFrame([entry("a", "new.org"), entry("b", "www.x.org"), entry("c", "y.org"), entry("d", "z.org", 3)], kind), schemas.CATALOG)
    assert [r["key"] for r in sinks.append_catalog(spark, f"{tmp_path}/c", new, 1).collect()] == ["c"]


def test_stream_is_batch(spark, tmp_path):
    rows = [(k, f"https://a/{k % 7}", f"t{k}", f"b{k}" if k % 3 else None, [f"g{k % 4}"], f"s{k}") for k in range(40)]
    kind = "seq long, url string, title string, content_body string, domain_tags array<string>, description string"
    whole = spark.createDataFrame(rows, kind)
    for k in range(4):
        spark.createDataFrame(rows[k * 10 : k * 10 + 10], kind).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    files = sorted(str(p) for p in (tmp_path / "in").rglob("*.parquet"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for n, f in enumerate(files):
        (flat / f"{n}.parquet").write_bytes(open(f, "rb").read())
    q = ingest.ingest(spark, str(flat), f"{tmp_path}/table", f"{tmp_path}/cp", whole.schema, files_per_batch=100)
    q.awaitTermination()
    batch = merge.merge_items(spark.createDataFrame([], ITEM), whole)
    got = sinks.Snapshots(spark, f"{tmp_path}/table").read(ITEM)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_give_up_stream_is_batch(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [("dead", False, 403, at(0)), ("dead", False, 500, at(30)), ("alive", False, 500, at(0)), ("alive", True, 200, at(5)), ("alive", False, 403, at(40)), ("young", False, 403, at(20))]
    spark.createDataFrame(rows, "domain string, ok boolean, http_status int, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("domain string, ok boolean, http_status int, at timestamp").parquet(f"{tmp_path}/in")
    q = ingest.give_ups(stream).writeStream.format("memory").queryName("give_ups").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["domain"]: (r["given_up"], r["ever_succeeded"], r["consecutive_403_count"]) for r in spark.table("give_ups").collect()}
    assert got == {"dead": (True, False, 1), "alive": (False, True, 1), "young": (False, False, 1)}
    states = spark.createDataFrame([], schemas.BLOCKED_DOMAINS)
    for h in sorted({r[3] for r in rows}):
        batch = spark.createDataFrame([r for r in rows if r[3] == h], "domain string, ok boolean, http_status int, at timestamp")
        states = merge.merge_blocked(states, state.domain_states(states, state.tally(batch), F.lit(h)))
    assert {r["domain"]: (r["given_up"], r["ever_succeeded"], r["consecutive_403_count"]) for r in states.collect()} == got


def test_bucket_and_breaker(spark):
    calls = spark.createDataFrame([("d", k, 0.0) for k in range(7)], "domain string, id long, at double")
    assert [round(r["passed_at"], 1) for r in state.token_bucket(calls, 60).orderBy("id").collect()] == [0, 0, 0, 0, 0, 1, 2]
    calls = spark.createDataFrame([("d", k, float(k), False) for k in range(6)] + [("d", 6, 400.0, True), ("d", 7, 401.0, True)], "domain string, id long, at double, ok boolean")
    assert [r["decision"] for r in state.circuit_breaker(calls).orderBy("id").collect()] == ["allowed"] * 5 + ["rejected", "allowed", "allowed"]


def test_snapshot_survives_a_crash(spark, tmp_path, monkeypatch):
    """A writer that dies before, while or after naming its folder leaves the table that was there."""
    store = sinks.Snapshots(spark, str(tmp_path / "t"))
    one, two = (spark.createDataFrame([(k,)], "x int") for k in (1, 2))
    assert store.write(one, 0) and [r["x"] for r in store.read("x int").collect()] == [1]

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks.Snapshots, "publish", dies)
        with pytest.raises(RuntimeError):
            store.write(two, 1)
    assert [r["x"] for r in sinks.Snapshots(spark, str(tmp_path / "t")).read("x int").collect()] == [1]
    assert store.write(two, 1) and not store.write(one, 1) and [r["x"] for r in store.read("x int").collect()] == [2]
    assert store.current()[1] == 1


def test_breaker_waits_for_its_probe(spark):
    calls = [("d", k, float(k), False) for k in range(5)] + [("d", 5, 10.0, True), ("d", 6, 304.0, None), ("d", 7, 310.0, True), ("d", 8, 364.0, False), ("d", 9, 400.0, True), ("d", 10, 664.0, True), ("d", 11, 665.0, False)]
    got = {r["id"]: r["decision"] for r in state.circuit_breaker(spark.createDataFrame(calls, "domain string, id long, at double, ok boolean")).collect()}
    assert [k for k, v in sorted(got.items()) if v == "rejected"] == [5, 7, 9]


def test_absent_rows_are_chosen_in_order(spark):
    stored = spark.createDataFrame([("a", 1)], "url string, x int")
    new = spark.createDataFrame([("b", 3), ("b", 2), ("a", 0), ("c", None), ("c", 5)], "url string, x int")
    assert sorted((r["url"], r["x"]) for r in merge.insert_absent(stored, new, "url").where("url <> 'c'").collect()) == [("a", 1), ("b", 2)]


def test_staleness_states(spark):
    from millrace.plans import views

    surfaces = spark.createDataFrame([("fresh", 1, True), ("stale", 1, True), ("never", 1, True), ("other", 2, True), ("off", 1, False)], "key string, authority_tier int, enabled boolean")
    items = spark.createDataFrame([("fresh", dt.datetime(2024, 1, 30)), ("fresh", dt.datetime(2023, 1, 1)), ("stale", dt.datetime(2024, 1, 20))], "surface_key string, collected_at timestamp_ntz")
    got = {r["key"]: r["state"] for r in views.tier_one_staleness(surfaces, items, F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00"))).collect()}
    assert got == {"fresh": "fresh", "stale": "stale", "never": "never"}


def test_near_duplicate_items_by_brute_force(spark):
    import random

    from millrace.operators import dedup

    draw = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    common, docs = [draw.choice(words) for _ in range(14)], {}
    for k in range(80):
        base = [draw.choice(words) for _ in range(draw.randrange(8, 60))]
        if k % 4 and docs:
            base = list(docs[draw.choice(list(docs))])
            for _ in range(draw.randrange(0, 4)):
                base[draw.randrange(len(base))] = draw.choice(words)
        docs[draw.randrange(10**6)] = base if k % 5 else common + base
    texts = {k: " ".join(v) + "!" * 60 for k, v in docs.items()}
    prints = {k: p for k, t in texts.items() if (p := dedup.frequent_runs(t))}
    want = {}
    for a, p in prints.items():
        near = [b for b, o in prints.items() if b < a and len(p) >= 10 and set(p[:10]) & set(o) and len(set(p) & set(o)) / len(set(p) | set(o)) > 0.7]
        if near:
            want[a] = min(near)
    rows = spark.createDataFrame(list(texts.items()), "id long, content_body string")
    assert {r["id"]: r["original"] for r in dedup.near_duplicates(dedup.fingerprints(rows)).collect()} == want and len(want) > 10


def test_list_index(spark):
    """Recall of the list index for ids divisible by 20 against the exact search; vectors of other widths, of zeros and null ones."""
    from millrace.plans.queries import QUERIES, stated_queries

    folder = "/root/testdata/sf0.01"
    e = spark.read.parquet(f"{folder}/embeddings.parquet")
    want = {(r["query_id"], r["id"]) for r in search.vector_topk_many(e, stated_queries(e), 10, "vec_id").collect()}
    got = {(r["query_id"], r["id"]) for r in QUERIES["ann_topk"](spark, folder).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(want) == 10 * stated_queries(e).count()
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0]), (4, [1.0, 0.1]), (5, [])], "id long, embedding array<double>")
    q = odd.where("id IN (0, 3)").selectExpr("id AS query_id", "embedding AS query")
    rows = sorted((r["query_id"], r["rank"], r["id"]) for r in search.vector_topk_many(odd, q, 5).collect())
    assert rows == [(0, 1, 0), (0, 2, 4), (3, 1, 3)]
    centres = search.list_centres(odd)
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in search.ann_topk(search.ann_index(odd, centres), q, centres, 5).collect()) == rows
    none = odd.limit(0)
    assert search.vector_topk_many(none, q, 5).collect() == [] == search.ann_topk(search.ann_index(none, search.list_centres(none)), q, search.list_centres(none)).collect()


def test_text_index(spark, tmp_path):
    docs = spark.createDataFrame([(1, "He sleeps; she is sleeping."), (2, "no sleep at all, sleep!"), (3, "awake"), (4, ""), (5, None)], "id long, text string")
    plain, stems = search.TextIndex(docs, str(tmp_path / "a")), search.TextIndex(docs, str(tmp_path / "b"), stem=True)
    assert sorted(r["id"] for r in plain.lookup(["sleep"]).collect()) == [2] and sorted(r["id"] for r in stems.lookup(["Sleeping"]).collect()) == [1, 2]
    assert {(r["term"], r["id"], r["len"], r["tf"]) for r in stems.postings.where("term = 'sleep'").collect()} == {("sleep", 1, 4, 2), ("sleep", 2, 4, 2)}
    assert (stems.n_docs, stems.mean_len) == (5, 9 / 5)
    assert [r["id"] for r in search.keyword_scan(docs, ["sleep"]).collect()] == [2]
    plan = plain.postings.where("term IN ('a', 'b')")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan


def test_atom_feed(spark):
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title>A</title><link rel="alternate" href="https://a.org/1"/><id>1</id><published>2024-01-02T00:00:00Z</published><content type="html">&lt;p&gt;C&lt;/p&gt;</content></entry><entry><title>B</title><link href="https://a.org/2"/></entry></feed>'
    rows = spark.createDataFrame([(atom,), ("<broken",), (None,)], "body string")
    got = sorted((r["title"], r["url"], r["description"], r["published_at"]) for r in payloads.rss(rows).collect())
    assert got == [("A", "https://a.org/1", "C", dt.datetime(2024, 1, 2)), ("B", "https://a.org/2", None, None)]


def test_interval_stream(spark, tmp_path):
    rows = spark.createDataFrame([(0, "u", "t")], "seq long, url string, title string")
    rows.write.parquet(str(tmp_path / "in"))
    query = ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "check"), rows.schema, every="1 second")
    try:
        query.processAllAvailable()
        assert [r["url"] for r in sinks.Snapshots(spark, str(tmp_path / "table")).read(ITEM).collect()] == ["u"]
    finally:
        query.stop()
