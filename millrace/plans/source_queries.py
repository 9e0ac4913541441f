"""Registered queries of the payload readers and of row-wise functions: payloads are built from documents, one record each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import chunking, dates, html, records, text
from millrace.operators import lifecycle, merge, search, state
from millrace.plans import corpus
from millrace.plans.corpus import ITEMS, table
from millrace.plans.queries import query
from millrace.sources import payloads

#: Sixty words of every document, long enough for an article.
SIXTY = "repeat(concat('word', doc_id, ' '), 60)"


def saved(spark, d: str, body: str, config: str = "CAST(NULL AS STRING)", **more: str) -> DataFrame:
    """A payload for each document. body, config and more: Spark SQL expressions."""
    return table(spark, d, "documents").selectExpr("doc_id", f"{body} AS body", f"{config} AS config", *(f"{e} AS {c}" for c, e in more.items()))


def seen(items: DataFrame, *columns: str) -> DataFrame:
    """Columns of collected items, times without zone."""
    return items.select(*(F.col(c).cast("timestamp_ntz").alias(c) if c == "published_at" else F.col(c) for c in columns))


@query(
    "SELECT 't3_' || doc_id AS external_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 3 = 0 THEN 'https://x.test/' || doc_id ELSE 'https://www.reddit.com/r/' || doc_id END AS url, "
    "CASE WHEN doc_id % 2 = 1 THEN 'S' || doc_id END AS description, make_timestamp((1700000000 + doc_id) * 1000000) AS published_at FROM documents WHERE doc_id % 5 <> 0"
)
def source_reddit(spark, d):
    post = "named_struct('title', IF(doc_id % 5 = 0, ' ', concat('T ', doc_id)), 'permalink', IF(doc_id % 3 = 0, NULL, concat('/r/', doc_id)), 'url', concat('https://x.test/', doc_id), 'name', concat('t3_', doc_id), 'selftext', IF(doc_id % 2 = 0, '', concat('S', doc_id)), 'author', 'ann', 'created_utc', CAST(1700000000 + doc_id AS DOUBLE), 'score', doc_id)"
    body = f"to_json(named_struct('data', named_struct('children', array(named_struct('data', {post})))))"
    return seen(payloads.reddit(saved(spark, d, body)), "external_id", "title", "url", "description", "published_at")


@query("SELECT 'g' || doc_id AS external_id, 'T ' || doc_id AS title, 'https://x.test/' || doc_id AS url, 'D ' || doc_id AS description, CASE WHEN doc_id % 2 = 1 THEN 'Ann' END AS author, TIMESTAMP '2024-01-01 00:00:00' AS published_at, 'Feed' AS journal FROM documents")
def source_rss(spark, d):
    rss = "concat('<rss version=\"2.0\"><channel><title>Feed</title><item><title>T ', doc_id, '</title><link> https://x.test/', doc_id, ' </link><guid>g', doc_id, '</guid><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate><description>&lt;p&gt;D  ', doc_id, '&lt;/p&gt;</description></item></channel></rss>')"
    atom = "concat('<feed xmlns=\"http://www.w3.org/2005/Atom\"><title>Feed</title><entry><title type=\"text\">T ', doc_id, '</title><link rel=\"self\" href=\"https://self.test/\"/><link href=\"https://x.test/', doc_id, '\"/><id>g', doc_id, '</id><updated>2024-01-01T00:00:00Z</updated><summary>D ', doc_id, '</summary><author><name>Ann</name></author></entry></feed>')"
    return seen(payloads.rss(saved(spark, d, f"IF(doc_id % 2 = 0, {rss}, {atom})")), "external_id", "title", "url", "description", "author", "published_at", "journal")


@query("SELECT doc_id::VARCHAR AS external_id, 'T ' || doc_id AS title, 'https://pubmed.ncbi.nlm.nih.gov/' || doc_id || '/' AS url, 'A B ' || doc_id AS description, 'Lee' AS author, '10.1/a' || doc_id AS doi, 'J' AS journal, TIMESTAMP '2020-03-01 00:00:00' AS published_at FROM documents")
def source_pubmed(spark, d):
    body = (
        "concat('<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>', doc_id, '</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year>2020</Year><Month>Mar</Month></PubDate></JournalIssue></Journal><ArticleTitle>T ', doc_id, "
        "'</ArticleTitle><Abstract><AbstractText>A</AbstractText><AbstractText>B ', doc_id, '</AbstractText></Abstract><AuthorList><Author><LastName>Lee</LastName><ForeName>Ann</ForeName></Author></AuthorList></Article></MedlineCitation>"
        "<PubmedData><ArticleIdList><ArticleId IdType=\"doi\">10.1/A', doc_id, '</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>')"
    )
    return seen(payloads.pubmed(saved(spark, d, body)), "external_id", "title", "url", "description", "author", "doi", "journal", "published_at")


@query(
    "SELECT CASE doc_id % 3 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN 'PMC' || doc_id END AS external_id, 'T ' || doc_id AS title, CASE doc_id % 3 WHEN 0 THEN 'https://europepmc.org/article/MED/' || doc_id WHEN 1 THEN 'https://europepmc.org/article/PMC/PMC' || doc_id ELSE 'https://doi.org/10.1/' || doc_id END AS url, "
    "'A' || doc_id AS description, doc_id % 2 = 0 AS open_access, TIMESTAMP '2019-01-01 00:00:00' AS published_at FROM documents"
)
def source_europepmc(spark, d):
    r = "named_struct('title', concat('T ', doc_id), 'pmid', IF(doc_id % 3 = 0, CAST(doc_id AS STRING), NULL), 'pmcid', IF(doc_id % 3 = 1, concat('PMC', doc_id), NULL), 'doi', concat('10.1/', doc_id), 'abstractText', concat('A', doc_id), 'isOpenAccess', IF(doc_id % 2 = 0, 'Y', 'N'), 'pubYear', '2019')"
    return seen(payloads.europepmc(saved(spark, d, f"to_json(named_struct('resultList', named_struct('result', array({r}))))")), "external_id", "title", "url", "description", "open_access", "published_at")


@query("SELECT 'W' || doc_id AS external_id, 'T ' || doc_id AS title, 'https://doi.org/10.1/a' || doc_id AS url, 'a' || doc_id || ' b' AS description, 'Lee' AS author, '10.1/a' || doc_id AS doi, doc_id % 2 = 0 AS open_access, TIMESTAMP '2020-01-02 00:00:00' AS published_at FROM documents")
def source_openalex(spark, d):
    r = "named_struct('id', concat('W', doc_id), 'title', concat('T ', doc_id), 'doi', concat('https://doi.org/10.1/A', doc_id), 'publication_date', '2020-01-02', 'authorships', array(named_struct('author', named_struct('display_name', 'Ann B. Lee'))), 'open_access', named_struct('is_oa', doc_id % 2 = 0), 'abstract_inverted_index', map('b', array(1), concat('a', doc_id), array(0)))"
    return seen(payloads.openalex(saved(spark, d, f"to_json(named_struct('results', array({r})))")), "external_id", "title", "url", "description", "author", "doi", "open_access", "published_at")


@query("SELECT 'p' || doc_id AS external_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'https://s.test/' || doc_id ELSE 'https://doi.org/10.2/' || doc_id END AS url, CASE WHEN doc_id % 3 <> 0 THEN 'A' || doc_id END AS description, 'Plato' AS author, TIMESTAMP '2018-01-01 00:00:00' AS published_at FROM documents")
def source_semanticscholar(spark, d):
    r = f"named_struct('paperId', concat('p', doc_id), 'title', concat('T ', doc_id), 'url', IF(doc_id % 2 = 0, concat('https://s.test/', doc_id), ''), 'externalIds', named_struct('DOI', concat('10.2/', doc_id)), 'year', 2018, 'abstract', IF(doc_id % 3 = 0, '{payloads.NO_ABSTRACT}', concat('A', doc_id)), 'authors', array(named_struct('name', 'Plato')))"
    return seen(payloads.semanticscholar(saved(spark, d, f"to_json(named_struct('data', array({r})))")), "external_id", "title", "url", "description", "author", "published_at")


@query("SELECT '10.1/a' || doc_id AS external_id, 'T ' || doc_id AS title, 'https://doi.org/10.1/a' || doc_id AS url, CASE WHEN doc_id % 2 = 0 THEN true END AS open_access, make_timestamp(2020, 1 + doc_id % 12, 1, 0, 0, 0) AS published_at, 'J' AS journal FROM documents")
def source_crossref(spark, d):
    r = "named_struct('title', array(concat('T ', doc_id)), 'DOI', concat('10.1/A', doc_id), 'published', named_struct('date-parts', array(array(2020, CAST(1 + doc_id % 12 AS INT)))), 'container-title', array('J'), 'license', IF(doc_id % 2 = 0, array(named_struct('URL', 'https://creativecommons.org/by')), NULL))"
    return seen(payloads.crossref(saved(spark, d, f"to_json(named_struct('message', named_struct('items', array({r}))))")), "external_id", "title", "url", "open_access", "published_at", "journal")


@query("SELECT '10.1/b' || doc_id AS external_id, 'An ODD one ' || doc_id AS title, 'https://doi.org/10.1/b' || doc_id AS url, 'Lee' AS author, TIMESTAMP '2021-05-06 00:00:00' AS published_at, 'medrxiv' AS journal FROM documents WHERE doc_id % 2 = 1 AND doc_id % 5 <> 0")
def source_biorxiv(spark, d):
    r = "named_struct('title', IF(doc_id % 2 = 1, concat('An ODD one ', doc_id), 'other'), 'abstract', 'none', 'doi', IF(doc_id % 5 = 0, NULL, concat('10.1/b', doc_id)), 'authors', 'Lee, A; B', 'date', '2021-05-06')"
    return seen(payloads.biorxiv(saved(spark, d, f"to_json(named_struct('collection', array({r})))", "'{\"query\": \"odd\"}'")), "external_id", "title", "url", "author", "published_at", "journal")


@query("SELECT 'd' || doc_id AS external_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'https://doi.org/10.1/' || doc_id WHEN doc_id % 3 = 0 THEN 'https://f.test/' || doc_id ELSE 'https://doaj.org/article/d' || doc_id END AS url, TIMESTAMP '2017-01-01 00:00:00' AS published_at, 'J' AS journal FROM documents")
def source_doaj(spark, d):
    b = "named_struct('title', concat('T ', doc_id), 'identifier', array(named_struct('type', 'issn', 'id', 'x'), named_struct('type', IF(doc_id % 2 = 0, 'doi', 'other'), 'id', concat('10.1/', doc_id))), 'link', IF(doc_id % 3 = 0, array(named_struct('type', 'fulltext', 'url', concat('https://f.test/', doc_id))), NULL), 'year', '2017', 'journal', named_struct('title', 'J'))"
    return seen(payloads.doaj(saved(spark, d, f"to_json(named_struct('results', array(named_struct('id', concat('d', doc_id), 'bibjson', {b}))))")), "external_id", "title", "url", "published_at", "journal")


@query("SELECT 'N' || doc_id AS external_id, CASE WHEN doc_id % 2 = 0 THEN 'Official ' ELSE 'Brief ' END || doc_id AS title, 'https://clinicaltrials.gov/study/N' || doc_id AS url, 'D' || doc_id AS content_body, 'S' AS author, TIMESTAMP '2022-03-01 00:00:00' AS published_at FROM documents")
def source_clinicaltrials(spark, d):
    p = "named_struct('identificationModule', named_struct('nctId', concat('N', doc_id), 'briefTitle', concat('Brief ', doc_id), 'officialTitle', IF(doc_id % 2 = 0, concat('Official ', doc_id), ' ')), 'descriptionModule', named_struct('detailedDescription', concat('D', doc_id)), 'statusModule', named_struct('startDateStruct', named_struct('date', '2022-03')), 'sponsorCollaboratorsModule', named_struct('leadSponsor', named_struct('name', 'S')))"
    return seen(payloads.clinicaltrials(saved(spark, d, f"to_json(named_struct('studies', array(named_struct('protocolSection', {p}))))")), "external_id", "title", "url", "content_body", "author", "published_at")


@query("SELECT doc_id::VARCHAR AS external_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'https://c.test/' || doc_id ELSE 'https://core.ac.uk/works/' || doc_id END AS url, CASE WHEN doc_id % 400 >= 200 THEN repeat('x', (doc_id % 400)::INT) END AS content_body, TIMESTAMP '2016-01-01 00:00:00' AS published_at FROM documents")
def source_core(spark, d):
    r = "named_struct('id', doc_id, 'title', concat('T ', doc_id), 'downloadUrl', IF(doc_id % 2 = 0, concat('https://c.test/', doc_id), NULL), 'fullText', repeat('x', CAST(doc_id % 400 AS INT)), 'yearPublished', 2016)"
    return seen(payloads.core(saved(spark, d, f"to_json(named_struct('results', array({r})))")), "external_id", "title", "url", "content_body", "published_at")


@query("SELECT doc_id::VARCHAR AS external_id, 'Page ' || doc_id AS title, 'https://en.wikipedia.org/wiki/Page_' || doc_id AS url, 'short' AS description, CASE WHEN doc_id % 3 = 0 THEN repeat('long ', 80) END AS content_body, TIMESTAMP '2023-02-03 04:05:06' AS published_at FROM documents WHERE doc_id % 4 <> 0")
def source_wikipedia(spark, d):
    body = "to_json(named_struct('type', IF(doc_id % 4 = 0, 'disambiguation', 'standard'), 'title', concat('Page ', doc_id), 'extract', 'short', 'timestamp', '2023-02-03T04:05:06Z', 'pageid', doc_id))"
    rows = saved(spark, d, body, "to_json(named_struct('title', concat('Page ', doc_id)))", extract="IF(doc_id % 3 = 0, repeat('long ', 80), 'short')")
    return seen(payloads.wikipedia(rows), "external_id", "title", "url", "description", "content_body", "published_at")


@query("SELECT 'h' || doc_id AS external_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'https://n.test/' || doc_id ELSE 'https://news.ycombinator.com/item?id=h' || doc_id END AS url, make_timestamp((1600000000 + doc_id) * 1000000) AS published_at FROM documents WHERE doc_id % 10 >= 7")
def source_hackernews(spark, d):
    r = "named_struct('title', concat('T ', doc_id), 'url', IF(doc_id % 2 = 0, concat('https://n.test/', doc_id), NULL), 'objectID', concat('h', doc_id), 'created_at_i', 1600000000 + doc_id, 'points', doc_id % 10)"
    return seen(payloads.hackernews(saved(spark, d, f"to_json(named_struct('hits', array({r})))", "'{\"min_points\": 7}'")), "external_id", "title", "url", "published_at")


@query("SELECT 'v' || doc_id AS external_id, 'T ' || doc_id AS title, 'https://www.youtube.com/watch?v=v' || doc_id AS url, CASE WHEN doc_id % 4 = 0 THEN 'spoken ' || doc_id END AS content_body, 'C' AS author FROM documents WHERE doc_id % 2 = 0 AND doc_id * 3 >= 50")
def source_youtube(spark, d):
    r = "named_struct('id', named_struct('videoId', concat('v', doc_id)), 'snippet', named_struct('title', concat('T ', doc_id), 'channelTitle', 'C', 'publishedAt', '2024-01-01T00:00:00Z'))"
    rows = saved(spark, d, f"to_json(named_struct('items', array({r})))", "'{\"min_views\": 50}'")
    docs = table(spark, d, "documents")
    views = docs.where("doc_id % 2 = 0").selectExpr("concat('v', doc_id) AS id", "doc_id * 3 AS view_count")
    spoken = docs.where("doc_id % 4 = 0").selectExpr("concat('v', doc_id) AS id", "concat('spoken ', doc_id) AS text")
    return seen(payloads.youtube(rows, views, spoken), "external_id", "title", "url", "content_body", "author")


@query("SELECT 'T ' || doc_id AS title, 'https://n.test/' || doc_id AS url, 'N' AS journal, TIMESTAMP '2024-01-01 10:00:00' AS published_at FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0")
def source_newsapi(spark, d):
    r = "named_struct('title', IF(doc_id % 3 = 0, '[Removed]', concat('T ', doc_id)), 'url', concat('https://n.test/', doc_id), 'source', named_struct('name', 'N'), 'publishedAt', '2024-01-01T10:00:00Z')"
    return seen(payloads.newsapi(saved(spark, d, f"to_json(named_struct('status', IF(doc_id % 2 = 0, 'ok', 'error'), 'articles', array({r})))")), "title", "url", "journal", "published_at")


PAGE = f"concat('<html><head><title>Tag ', doc_id, '</title><meta property=\"og:site_name\" content=\"Site\">', %s, '<meta name=\"description\" content=\"D ', doc_id, '\"></head><body><nav>menu</nav><article><h1>Head ', doc_id, '</h1><p>', {SIXTY}, '</p></article></body></html>')"
PAGE_SQL = "'D ' || doc_id AS description, 'Head ' || doc_id || ' ' || rtrim(repeat('word' || doc_id || ' ', 60)) AS content_body, 'Site' AS journal"
OPEN_GRAPH = "IF(doc_id % 2 = 0, concat('<meta property=\"og:title\" content=\"OG ', doc_id, '\">'), '')"


@query(
    "SELECT 'https://x.test/' || doc_id AS url, CASE WHEN doc_id % 2 = 0 THEN 'OG ' ELSE 'Head ' END || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'D ' || doc_id END AS description, "
    "'Head ' || doc_id || ' ' || rtrim(repeat('word' || doc_id || ' ', 60)) AS content_body, CASE WHEN doc_id % 2 = 0 THEN 'Site' END AS journal FROM documents"
)
def source_html_pages(spark, d):
    return seen(payloads.html_pages(saved(spark, d, PAGE % OPEN_GRAPH, url="concat('https://x.test/', doc_id)")), "url", "title", "description", "content_body", "journal")


@query(f"SELECT 'https://x.test/' || doc_id AS url, 'Tag ' || doc_id AS title, {PAGE_SQL} FROM documents WHERE doc_id % 3 <> 0")
def source_browser_pages(spark, d):
    page = (PAGE % "''").replace("<title>Tag ', doc_id, '</title>", "<title>', IF(doc_id % 3 = 0, 'Just a moment...', concat('Tag ', doc_id)), '</title>")
    return seen(payloads.browser_pages(saved(spark, d, page, url="concat('https://x.test/', doc_id)")), "url", "title", "description", "content_body", "journal")


@query(f"SELECT 'https://x.test/' || doc_id AS url, CASE WHEN doc_id % 2 = 0 THEN 'OG ' ELSE 'Tag ' END || doc_id AS title, {PAGE_SQL} FROM documents")
def source_sitemap(spark, d):
    return seen(payloads.sitemap(saved(spark, d, PAGE % OPEN_GRAPH, url="concat('https://x.test/', doc_id)")), "url", "title", "description", "content_body", "journal")


@query("SELECT unnest(['https://x.test/en/' || doc_id, 'https://x.test/s' || doc_id || '.xml']) AS url, unnest(['page', 'sitemap']) AS kind, unnest([0, 2])::INT AS position FROM documents")
def sitemap_urls(spark, d):
    body = "concat('<x><url><loc> https://x.test/en/', doc_id, ' </loc></url><url><loc>https://x.test/de/', doc_id, '</loc></url><sitemap><loc>https://x.test/s', doc_id, '.xml</loc></sitemap></x>')"
    return payloads.sitemap_urls(saved(spark, d, body), "/en/")


@query("SELECT 'https://n.test/a/' || doc_id || '/' AS url, 'Head ' || doc_id AS title, 'a/' || doc_id AS external_id, TIMESTAMP '2024-03-05 00:00:00' AS published_at, 'nhs.uk' AS journal FROM documents")
def source_nhs_api(spark, d):
    page = f"concat('<html><head><title>Tag - NHS</title></head><body><main><h1>Head ', doc_id, ' - NHS</h1><p>', {SIXTY}, '</p><p>Page last reviewed: 5 March 2024</p></main></body></html>')"
    return seen(payloads.nhs_api(saved(spark, d, page, url="concat('https://n.test/a/', doc_id, '/')")), "url", "title", "external_id", "published_at", "journal")


@query("SELECT 'c' || doc_id AS external_id, 'T ' || doc_id AS title, 'https://data.cdc.gov/dataset/c' || doc_id AS url, 'Dataset: T ' || doc_id || chr(10) || chr(10) || 'k: v, n: ' || doc_id AS content_body, 'CDC' AS author FROM documents")
def source_cdc_data(spark, d):
    body = "to_json(named_struct('id', concat('c', doc_id), 'name', concat('T ', doc_id), 'viewCount', doc_id))"
    return seen(payloads.cdc_data(saved(spark, d, body, rows="concat('[{\"k\": \"v\", \"n\": \"', doc_id, '\"}]')")), "external_id", "title", "url", "content_body", "author")


@query("SELECT unnest(['doi:10.1/a' || doc_id, 'pmid:' || (10000 + doc_id)]) AS external_id, unnest(['https://doi.org/10.1/a' || doc_id, 'https://pubmed.ncbi.nlm.nih.gov/' || (10000 + doc_id) || '/']) AS url, unnest(['10.1/a' || doc_id, NULL]) AS doi FROM documents")
def source_link_harvester(spark, d):
    items = table(spark, d, "documents").selectExpr("concat('see doi.org/10.1/a', doc_id, ' and pubmed.ncbi.nlm.nih.gov/', 10000 + doc_id, '; again doi.org/10.1/a', doc_id) AS content_body")
    return payloads.link_harvester(items).select("external_id", "url", "doi")


@query("SELECT doc_id AS id, 'doi:10.1/' || doc_id AS external_id, 'doi' AS stub_type, 'T ' || doc_id AS title FROM documents WHERE doc_id % 3 = 0")
def source_link_harvester_backfill(spark, d):
    docs = table(spark, d, "documents")
    stubs = docs.selectExpr("doc_id AS id", "concat('doi:10.1/', doc_id) AS external_id")
    return payloads.link_harvester_backfill(stubs, docs.where("doc_id % 3 = 0").selectExpr("concat('doi:10.1/', doc_id) AS external_id", "concat('T ', doc_id) AS title"))


# --- row-wise functions and small operators

@query("SELECT doc_id, doc_id % 6 IN (0, 1, 2) AS empty FROM documents")
def no_content_titles(spark, d):
    title = F.expr("CASE doc_id % 6 WHEN 0 THEN 'Just a Moment...' WHEN 1 THEN 'Error: 404 NOT FOUND' WHEN 2 THEN 'Access Denied' WHEN 3 THEN 'A moment' WHEN 4 THEN '' END")
    return table(spark, d, "documents").select("doc_id", text.is_no_content_title(title).alias("empty"))


@query("SELECT doc_id, doc_id % 4 <> 0 AND doc_id % 3 IN (1, 2) AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 AS valid FROM documents")
def entry_validity(spark, d):
    key, tier = F.expr("IF(doc_id % 4 = 0, '', concat('k', doc_id))"), F.expr("CAST(doc_id % 3 AS INT)")
    platform, config = F.expr("IF(doc_id % 5 = 0, 'rss', 'html_pages')"), F.expr("IF(doc_id % 7 = 0, '{}', '{\"base_url\": \"https://x.test\"}')")
    return table(spark, d, "documents").select("doc_id", records.entry_is_valid(key, platform, tier, config).alias("valid"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN TIMESTAMP '2024-02-03 04:05:06' WHEN 1 THEN TIMESTAMP '2024-02-03 00:00:00' WHEN 2 THEN TIMESTAMP '2024-02-03 04:05:06' WHEN 3 THEN TIMESTAMP '2024-02-01 00:00:00' WHEN 4 THEN TIMESTAMP '2024-01-01 00:00:00' END AS published, make_timestamp(doc_id * 1000000) AS epoch FROM documents")
def published_dates(spark, d):
    raw = F.expr("CASE doc_id % 6 WHEN 0 THEN '2024-02-03T04:05:06Z' WHEN 1 THEN '2024-02-03' WHEN 2 THEN 'Sat, 3 Feb 2024 04:05:06 GMT' WHEN 3 THEN '2024-02' WHEN 4 THEN '2024' ELSE 'soon' END")
    return table(spark, d, "documents").select("doc_id", dates.parse_published(raw).cast("timestamp_ntz").alias("published"), dates.from_epoch(F.col("doc_id").cast("string")).cast("timestamp_ntz").alias("epoch"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN NULL ELSE 'Ann ' || doc_id END AS name FROM documents")
def author_values(spark, d):
    value = F.expr("CASE doc_id % 4 WHEN 0 THEN concat('{\"name\": \"Ann ', doc_id, '\"}') WHEN 1 THEN concat('[{\"name\": \"Ann ', doc_id, '\"}, {\"name\": \"B\"}]') WHEN 2 THEN concat('Ann ', doc_id) END")
    return table(spark, d, "documents").select("doc_id", records.author_name(value).alias("name"))


@query("SELECT doc_id, 'auto_www_s' || doc_id || '_org' AS key, 'https://www.s' || doc_id || '.org' AS base, (1 + doc_id % 2)::VARCHAR AS tier FROM documents")
def auto_entries(spark, d):
    verdict = F.struct(F.expr("CAST(1 + doc_id % 2 AS INT)").alias("tier"), F.lit("academic").alias("source_type"), F.lit("mixed").alias("audience_type"))
    entry = records.auto_entry(F.expr("concat('www.s', doc_id, '.org')"), verdict, F.array(F.lit("sleep")))
    got = table(spark, d, "documents").select("doc_id", entry.alias("e"))
    return got.select("doc_id", *(F.get_json_object("e", p).alias(n) for n, p in (("key", "$.key"), ("base", "$.config.base_url"), ("tier", "$.authority_tier"))))


@query("SELECT doc_id, 'site:s.org topic' || chr(10) || 'Known:' || chr(10) || CASE WHEN doc_id % 40 = 0 THEN '(none yet)' ELSE array_to_string(list_transform(range(least(doc_id % 40, 30)), lambda i: '- u' || i), chr(10)) END AS prompt FROM documents")
def search_prompts(spark, d):
    known = F.expr("transform(slice(sequence(0, 39), 1, CAST(doc_id % 40 AS INT)), i -> concat('u', i))")
    return table(spark, d, "documents").select("doc_id", records.search_prompt(F.lit("s.org"), F.lit("topic"), known).alias("prompt"))


@query("SELECT doc_id, unnest(['H', '']) AS heading, unnest(['[H] one ' || doc_id, 'two ' || doc_id]) AS chunk FROM documents")
def section_chunks(spark, d):
    sections = F.expr("array(named_struct('heading', 'H', 'level', 1, 'text', concat('one ', doc_id)), named_struct('heading', '', 'level', 0, 'text', concat('two ', doc_id)), named_struct('heading', 'E', 'level', 2, 'text', ''))")
    return table(spark, d, "documents").select("doc_id", F.inline(chunking.chunk_sections(sections)))


@query("SELECT doc_id, 'LD ' || doc_id AS ld_title, 'Ann' AS author, 'OG ' || doc_id AS meta_title, 'Head ' || doc_id AS h1, '2024-05-06' AS at FROM documents")
def page_metadata(spark, d):
    page = F.expr("concat('<html><head><meta property=\"og:title\" content=\"OG ', doc_id, '\"><script type=\"application/ld+json\">{\"@graph\": [{\"@type\": \"Thing\", \"name\": \"no\"}, {\"@type\": \"Article\", \"headline\": \"LD ', doc_id, '\", \"author\": [{\"name\": \"Ann\"}]}]}</script></head><body><h1>Head ', doc_id, '</h1><time datetime=\"2024-05-06\">May</time></body></html>')")
    got = table(spark, d, "documents").select("doc_id", html.extract_json_ld(page).alias("ld"), html.extract_meta(page).alias("meta"), html.extract_by_selectors(page, {"h1": "h1", "at": "time"}).alias("s"))
    return got.select("doc_id", F.col("ld.title").alias("ld_title"), "ld.author", F.col("meta.title").alias("meta_title"), "s.h1", "s.at")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'T ' || rtrim(repeat('word' || doc_id || ' ', 60)) END AS text FROM documents")
def xml_texts(spark, d):
    xml = F.expr(f"IF(doc_id % 2 = 0, concat('<a><t>T</t>\\n<b>', {SIXTY}, '</b></a>'), IF(doc_id % 3 = 0, '<a>short</a>', '<broken'))")
    return table(spark, d, "documents").select("doc_id", html.extract_xml_text(xml).alias("text"))


@query("SELECT id, CASE WHEN id % 2 = 0 THEN 'pmc' WHEN id % 3 = 0 THEN 'pdf' ELSE 'page' END AS taken FROM items", ITEMS)
def publisher_texts(spark, d):
    url = F.expr("CASE WHEN id % 2 = 0 THEN concat('https://pmc.ncbi.nlm.nih.gov/articles/PMC', id) WHEN id % 3 = 0 THEN concat('https://x.test/', id, '.pdf') ELSE concat('https://x.test/', id) END")
    of = lambda name: F.expr(f"repeat('{name} ', 100)")
    taken = lifecycle.publisher_order(url, of("pmc"), of("xml"), of("page"), of("pdf"))
    return corpus.items(spark, d).select("id", F.split_part(taken, F.lit(" "), F.lit(1)).alias("taken"))


@query("SELECT id, CASE WHEN id % 3 = 0 THEN 'fetched ' || id ELSE content_body END AS content_body FROM items", ITEMS)
def fetched_bodies(spark, d):
    i = corpus.items(spark, d)
    return lifecycle.with_bodies(i, i.where("id % 3 = 0").selectExpr("url", "concat('fetched ', id) AS text")).select("id", "content_body")


@query("SELECT 'https://s.test/' || doc_id AS url, '10.1000/y' || doc_id AS doi FROM documents WHERE doc_id % 4 NOT IN (0, 1)")
def new_stub_links(spark, d):
    docs, i = table(spark, d, "documents"), corpus.items(spark, d)
    known = i.where("id % 4 = 0").selectExpr("concat('https://s.test/', id) AS url", "CAST(NULL AS STRING) AS doi").union(i.where("id % 4 = 1").selectExpr("concat('https://other.test/', id)", "concat('10.1000/y', id)"))
    return merge.new_stubs(docs.selectExpr("concat('https://s.test/', doc_id) AS url", "concat('10.1000/y', doc_id) AS doi"), known)


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'url' || CASE WHEN doc_id % 2 = 0 THEN ',title' ELSE '' END WHEN doc_id % 2 = 0 THEN 'title' END AS missing FROM documents")
def rejected_rows(spark, d):
    rows = table(spark, d, "documents").selectExpr("doc_id", "IF(doc_id % 3 = 0, NULL, 'u') AS url", "IF(doc_id % 2 = 0, NULL, 't') AS title")
    good, bad = merge.split_rejects(rows, "url", "title")
    return good.select("doc_id", F.lit(None).cast("string").alias("missing")).union(bad.select("doc_id", F.array_join("missing", ",")))


@query("SELECT vec_id AS id, vec_id % 3 <> 0 AS has, CASE WHEN vec_id % 3 = 0 THEN 'm2' ELSE 'm1' END AS embedding_model FROM embeddings")
def vectors_written_back(spark, d):
    items = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", F.lit("m1").alias("embedding_model"))
    made = items.where("id % 3 = 0").select("id", F.array(F.lit(0.5).cast("float")).alias("embedding"), F.lit("m2").alias("embedding_model"))
    return search.write_back(items, made).select("id", (F.size("embedding") > 1).alias("has"), "embedding_model")


@query("SELECT vec_id AS id, true AS gone FROM embeddings")
def vectors_reset(spark, d):
    items = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", F.lit("m1").alias("embedding_model"))
    return merge.reset_embeddings(items).select("id", (F.col("embedding").isNull() & F.col("embedding_model").isNull()).alias("gone"))


@query("SELECT vec_id FROM embeddings WHERE vec_id % 5 <> 1")
def outdated_vectors(spark, d):
    rows = table(spark, d, "embeddings").withColumn("embedding_schema_version", F.expr("CASE vec_id % 5 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' END"))
    return search.outdated(rows, "v2").select("vec_id")


@query("SELECT 'd' || doc_id AS domain FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 1")
def newly_given_up(spark, d):
    states = lambda cond: table(spark, d, "documents").selectExpr("concat('d', doc_id) AS domain", f"{cond} AS given_up")
    return state.newly_given_up(states("doc_id % 2 = 0"), states("doc_id % 3 = 0"))


@query("SELECT page_id, regexp_replace(url, '/+$', '') IN (SELECT regexp_replace(url, '/+$', '') FROM pages WHERE page_id % 3 = 0) AS known FROM pages")
def known_landings(spark, d):
    pages = table(spark, d, "pages")
    return lifecycle.with_known(pages.select("page_id", "url"), pages.where("page_id % 3 = 0").select("url")).select("page_id", "known")


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '─' ELSE round_even(doc_id % 7 * 100.0 / 7, 0)::INT || '%' END AS share FROM documents")
def shares(spark, d):
    return table(spark, d, "documents").select("doc_id", text.percent(F.expr("doc_id % 7"), F.expr("IF(doc_id % 7 = 0, 0, 7)")).alias("share"))
