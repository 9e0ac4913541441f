"""Surfaces as streams: cursors as offsets, errors, failures, rejects."""

import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.sources import payloads, sinks
from millrace.sources.buckets import ItemStore
from millrace.streaming import platforms


def save(root, surface, run, cursor, body, status=200, **more):
    at = root / surface / str(run)
    at.mkdir(parents=True, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body)
    (at / f"{platforms.quote(cursor, safe='') if cursor else 'first'}.json").write_text(json.dumps({"status": status, "body": text, **more}))


def surface(root, key, platform, **config):
    (root / key).mkdir(parents=True, exist_ok=True)
    (root / key / "surface.json").write_text(json.dumps({"platform": platform, "config": config}))


def posts(*names, after=None):
    return {"data": {"children": [{"data": {"title": f"T {n}", "permalink": f"/r/{n}"}} for n in names], "after": after}}


def works(n, total):
    return {"data": [{"paperId": f"p{k}", "title": f"P {k}", "url": f"https://s/{k}"} for k in n], "total": total}


def urls(store):
    return sorted(r["url"].rsplit("/", 1)[1] for r in store.read("items").select("url").collect())


def test_cursors_are_offsets(spark, tmp_path):
    """Pages are followed by each platform's rule; an error leaves its surface's cursor, others go on; nothing is read twice."""
    root, store = tmp_path / "in", ItemStore(spark, f"{tmp_path}/items", buckets=4)
    states = sinks.Snapshots(spark, f"{tmp_path}/states")
    states.write(schemas.conform(spark.createDataFrame([("a", "reddit"), ("b", "semanticscholar")], "key string, platform string"), schemas.SURFACES), 0)
    surface(root, "a", "reddit")
    surface(root, "b", "semanticscholar")
    save(root, "a", 0, None, posts("a1", "a2", after="t3/x"))
    save(root, "a", 0, "t3/x", posts("a3", after="t3/y"))
    save(root, "a", 0, "t3/y", "down", status=503)
    save(root, "b", 0, None, works(range(2), 3))
    save(root, "b", 0, "2", works([2], 3))
    go = lambda: platforms.collect(spark, str(root), store, f"{tmp_path}/rejects", f"{tmp_path}/checkpoint", pages=1, surfaces=(states, schemas.SURFACES)).awaitTermination()
    for _ in range(4):  # one page of a surface each time
        go()
    assert urls(store) == ["0", "1", "2", "a1", "a2", "a3"]
    state = {r["key"]: r for r in states.read(schemas.SURFACES).collect()}
    assert (state["a"]["last_cursor"], state["a"]["last_status"], state["a"]["last_error"], state["a"]["consecutive_fails"]) == ("t3/y", "error", "http_503", 1)
    assert (state["b"]["last_cursor"], state["b"]["last_status"]) == (None, "ok")
    batches = store.manifest()["batch"]
    go()  # the same error is not reported again
    assert store.manifest()["batch"] == batches and {r["key"]: r["consecutive_fails"] for r in states.read(schemas.SURFACES).collect()}["a"] == 1
    save(root, "a", 0, "t3/y", posts("a4"))
    save(root, "b", 1, None, works([9], 1))  # the next run begins where it has to
    go()
    assert urls(store) == ["0", "1", "2", "9", "a1", "a2", "a3", "a4"]
    assert {r["key"]: (r["last_status"], r["consecutive_fails"]) for r in states.read(schemas.SURFACES).collect()} == {"a": ("ok", 0), "b": ("ok", 0)}


def test_a_failure_repeats_and_loses_nothing(spark, tmp_path, monkeypatch):
    root, store = tmp_path / "in", ItemStore(spark, f"{tmp_path}/items", buckets=4)
    surface(root, "a", "reddit")
    save(root, "a", 0, None, posts("a1", after="x"))
    save(root, "a", 0, "x", posts("a2", "a1"))
    go = lambda: platforms.collect(spark, str(root), store, f"{tmp_path}/rejects", f"{tmp_path}/checkpoint").awaitTermination()
    merge = ItemStore.merge
    for before in (True, False):
        seen = []

        def dies(self, items, number, *rest):
            seen.append(sorted(r["url"] for r in items.select("url").collect()))
            if not before:
                merge(self, items, number, *rest)
            raise RuntimeError("lost")

        with monkeypatch.context() as m:
            m.setattr(ItemStore, "merge", dies)
            with pytest.raises(Exception, match="lost"):
                go()
        assert len(seen) == 1 and len(seen[0]) == (3 if before else 1)
        go()
        assert urls(store) == (["a1", "a2"] if before else ["a1", "a2", "a3"])
        save(root, "a", 1, None, posts("a3"))
    assert store.read("items").where("url LIKE '%a1'").count() == 1
    assert [r["title"] for r in store.read("items").where("url LIKE '%a3'").collect()] == ["T a3"]


GOOD = {
    "reddit": posts("x"), "openalex": {"results": [{"title": "T", "doi": "10.1/o"}]}, "crossref": {"message": {"items": [{"title": ["T"], "DOI": "10.1/x"}]}},
    "europepmc": {"resultList": {"result": [{"title": "T", "pmid": "1"}]}}, "semanticscholar": works([1], 1), "doaj": {"results": [{"id": "d", "bibjson": {"title": "T"}}]},
    "clinicaltrials": {"studies": [{"protocolSection": {"identificationModule": {"nctId": "N", "briefTitle": "T"}}}]}, "core": {"results": [{"id": 9, "title": "T"}]},
    "hackernews": {"hits": [{"title": "T", "objectID": "7", "points": 9}]}, "newsapi": {"status": "ok", "articles": [{"title": "T", "url": "https://n"}]},
    "biorxiv": {"collection": [{"title": "T", "doi": "10.1/b"}]}, "youtube": {"items": [{"id": {"videoId": "v"}, "snippet": {"title": "T"}}]}, "wikipedia": {"title": "T", "pageid": 1, "type": "standard"},
    "cdc_data": {"id": "i", "name": "T"}, "rss": "<rss><channel><title>F</title><item><title>T</title><link>https://u</link></item></channel></rss>",
    "pubmed": "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>",
    **{p: "<html><head><title>T</title></head><body><h1>T</h1></body></html>" for p in ("html_pages", "browser_pages", "sitemap", "nhs_api")},
}
PAGES = ("html_pages", "browser_pages", "sitemap", "nhs_api")


def test_rejects_of_every_platform(spark, tmp_path):
    """A malformed response and an empty one of each platform are kept with their reasons; the good ones go on."""
    root, store = tmp_path / "in", ItemStore(spark, f"{tmp_path}/items", buckets=4)
    for p, good in GOOD.items():
        for kind, body in (("good", good), ("bad", "<p>no title" if p in PAGES else '{"cut off": [' if not str(good).startswith("<") else "<rss><chan"), ("blank", " ")):
            key = f"{p}-{kind}"
            surface(root, key, p, title="A b", titles=["A b"])
            save(root, key, 0, None, body, url=f"https://site/{key}")
    platforms.collect(spark, str(root), store, f"{tmp_path}/rejects", f"{tmp_path}/checkpoint").awaitTermination()
    assert {r["surface_key"] for r in store.read("items").collect()} == {f"{p}-good" for p in GOOD}
    bad = {r["surface_key"]: r for r in platforms.read_rejects(spark, f"{tmp_path}/rejects").collect()}
    assert set(bad) == {f"{p}-{kind}" for p in GOOD for kind in ("bad", "blank")}
    assert {r["reason"] for k, r in bad.items() if k.endswith("bad")} == {"malformed", "no title"}
    assert all((r["platform"], r["seq"]) == (k.rpartition("-")[0], 1_000_000) and (r["raw"] or "").strip() for k, r in bad.items() if k.endswith("bad"))


def test_records_that_are_no_items(spark):
    """Records are sorted out one by one, with their number in the response."""
    body = {"hits": [{"title": "T", "objectID": "1", "points": 9}, {"title": " ", "objectID": "2", "points": 9}, {"title": "low", "objectID": "3", "points": 1}, None, 5]}
    rows = spark.createDataFrame([("s", 4, json.dumps(body), None), ("s", 5, '{"hits": "none"}', None), ("s", 6, '{"hits": []}', None), ("s", 7, "{}", None)], "surface_key string, seq long, body string, config string")
    items, rejects = payloads.sorted_out(payloads.marked("hackernews", rows), "hackernews")
    assert [(r["external_id"], r["seq"]) for r in items.collect()] == [("1", 4_000_000)]
    assert sorted((r["seq"], r["record"], r["reason"]) for r in rejects.collect()) == [(4_000_001, 1, "no title"), (4_000_003, 3, "record malformed"), (4_000_004, 4, "record malformed"), (5_000_000, 0, "malformed"), (7_000_000, 0, "no records")]
    assert payloads.hackernews(rows).select("external_id").collect() == items.select("external_id").collect()
    assert json.loads(rejects.where("reason = 'no title'").first()["raw"])["objectID"] == "2"


def test_every_saved_platform_has_a_cursor_rule():
    assert set(platforms.PAGED) | set(platforms.POLLED) == set(payloads.READERS) - {"link_harvester", "link_harvester_backfill"}
    assert platforms.moved("biorxiv", None, {"body": json.dumps({"collection": [1, 2], "messages": [{"total": "5"}]})}, {"start": "2024-01-01"}) == ("2024-01-01/2", False)
    assert platforms.moved("rss", "2024-01-02", {"body": "<rss/>", "newest": "2024-02-01"}, {}) == ("2024-02-01", True)
    assert platforms.moved("openalex", "x", {"body": "not json"}, {}) == (None, True)
    assert platforms.moved("wikipedia", "A", {"body": '{"title": "B"}'}, {"titles": ["A", "B"]}) == (None, True)
