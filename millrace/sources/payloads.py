"""Saved payloads of each platform into collected items.

A payload table has one response a row: body (text) and, where the platform needs it, url and config (JSON); surface_key
and seq go along if it has them. Every reader is a projection with an explicit schema. Responses that can't be read and
records without title or address are no items: a reader leaves them out, its `marked` form keeps them with the reason, so
that one pass gives items and rejects (see sorted_out).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates, html, urls
from millrace.functions.records import abstract_from_index, split_name, tabular_text
from millrace.functions.text import clean_text, normalize_doi
from millrace.schemas import COLLECTED

#: What a service writes where it may not give an abstract.
NO_ABSTRACT = "Abstract not available"


def blank_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first(*options: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*(F.when(F.trim(o) != "", o) for o in options))


def doi_url(doi: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), doi)


def names(list_of: Column, name: str = "name") -> Column:
    """Authors from full names."""
    return F.transform(F.filter(list_of, lambda a: F.coalesce(a[name], F.lit("")) != ""), lambda a: split_name(a[name]))


#: What goes along with a payload into its items.
CARRIED = ("surface_key", "seq")
#: The column of the rows that are no items: reason, raw text, number of the record in its response.
REJECT = "__reject"
WHY, PLACE = "__why", "__place"
CORRUPT = "_corrupt_record"

#: Readers by platform; the names that a catalog may use.
READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Registers a reader. Called, it gives items; its `marked` gives all rows, with REJECT set where they are none."""

    @functools.wraps(f)
    def items(*payloads: DataFrame, **how) -> DataFrame:
        rows = f(*payloads, **how)
        return rows.where(F.col(REJECT).isNull()).drop(REJECT) if REJECT in rows.columns else rows

    items.marked = f
    READERS[f.__name__] = items
    return items


def carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def collected(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """Every column of the schema, with what is carried along and REJECT. A record's seq is its response's, then its number there."""
    given = {"title": F.trim(columns.pop("title")), "source": F.lit(source), **columns}
    if "authors_json" in given:
        given["authors_json"] = F.when(F.size(given["authors_json"]) > 0, given["authors_json"])
        given.setdefault("author", F.get(given["authors_json"], F.lit(0))["family"])
    place = F.coalesce(PLACE, F.lit(0)) if PLACE in df.columns else F.lit(0)
    along = [(F.col("seq") * 1_000_000 + place).cast("long").alias("seq") if c == "seq" else F.col(c) for c in carried(df)]
    why = F.col(WHY) if WHY in df.columns else F.lit(None).cast("string")
    raw = F.col("body") if "body" in df.columns else F.lit(None).cast("string")
    record = F.col("x") if "x" in df.columns else F.to_json("r") if "r" in df.columns else raw
    raw = F.when(why.isNull(), record).otherwise(raw)
    row = df.select(*((given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in COLLECTED), *along, why.alias(WHY), raw.alias("__raw"), place.cast("int").alias(PLACE))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    reason = F.coalesce(WHY, F.when(blank("title"), "no title"), F.when(blank("url"), "no url"))
    reject = F.when(reason.isNotNull(), F.struct(reason.alias("reason"), F.col("__raw").alias("raw"), F.col(PLACE).alias("record")))
    return row.withColumn(REJECT, reject).drop(WHY, "__raw", PLACE)


def unread(condition: Column) -> Column:
    """condition for records; what could not be read passes, as a reject."""
    return F.col(WHY).isNotNull() | condition


def opened(payloads: DataFrame, doc: Column, records: Callable[[Column], Column], broken: Column) -> DataFrame:
    """One row r for each record of a response, and one with the reason for a response or record that can't be read; none for an
    empty list. broken: whether the response as a whole is malformed."""
    rows = payloads.withColumn("__doc", doc).withColumn("__list", records(F.col("__doc")))
    rows = rows.select("*", F.posexplode_outer("__list").alias(PLACE, "r"))
    why = F.when(F.coalesce(F.trim("body"), F.lit("")) == "", "no body").when(broken & F.col("__list").isNull(), "malformed").when(F.col("__list").isNull(), "no records").when(F.size("__list") > 0, "record malformed")
    return rows.withColumn(WHY, F.when(F.col("r").isNull(), why)).where(F.col("r").isNotNull() | F.col(WHY).isNotNull())


class Keys(list):
    """The names that a path asks for."""

    def __getitem__(self, key):
        self.append(key)
        return self


def with_raw_records(kind: T.DataType, keys: list[str]) -> tuple[T.DataType, T.DataType]:
    """A schema in which the records at the end of keys stay text, and the type that the records have."""
    if not keys:
        return T.ArrayType(T.StringType()), kind.elementType
    inner, record = with_raw_records(kind[keys[0]].dataType, keys[1:])
    return T.StructType([T.StructField(keys[0], inner)]), record


def exploded(payloads: DataFrame, schema: str, path: Callable[[Column], Column]) -> DataFrame:
    """opened() for a JSON response. Where one record of the wrong type spoils the list, records are read one by one."""
    doc = F.from_json("body", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    path(names := Keys())
    raw, record = with_raw_records(T.StructType.fromDDL(schema), list(names))
    one_by_one = F.transform(path(F.from_json("body", raw)), lambda x: F.when(F.ltrim(x).startswith("{"), F.from_json(x, record)))
    return opened(payloads, doc, lambda d: F.coalesce(path(d), one_by_one), F.col(f"__doc.{CORRUPT}").isNotNull() | F.col("__doc").isNull())


def single(payloads: DataFrame, schema: str, name: str) -> DataFrame:
    """The response's one record as a column."""
    doc = F.from_json("body", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    broken = F.col(f"{name}.{CORRUPT}").isNotNull() | F.col(name).isNull()
    why = F.when(F.coalesce(F.trim("body"), F.lit("")) == "", "no body").when(broken, "malformed")
    return payloads.withColumn(name, doc).withColumn(WHY, why)


@reader
def reddit(payloads: DataFrame) -> DataFrame:
    rows = exploded(payloads, "data struct<children:array<struct<data:struct<title:string,permalink:string,url:string,name:string,selftext:string,author:string,created_utc:double,score:long,upvote_ratio:double,num_comments:long>>>,after:string>", lambda d: d["data"]["children"])
    p = F.col("r.data")
    return collected(
        rows, "reddit", title=p["title"], url=F.when(F.coalesce(p["permalink"], F.lit("")) != "", F.concat(F.lit("https://www.reddit.com"), p["permalink"])).otherwise(p["url"]), external_id=p["name"], description=blank_null(p["selftext"]), author=p["author"],
        published_at=F.timestamp_seconds(p["created_utc"]), engagement=F.to_json(F.struct(F.coalesce(p["score"], F.lit(0)).alias("score"), p["upvote_ratio"].alias("upvote_ratio"), F.coalesce(p["num_comments"], F.lit(0)).alias("num_comments"))), raw_payload=F.to_json(p),
    )


FEED = (
    "channel struct<title:string,item:array<struct<title:string,link:string,guid:string,pubDate:string,description:string,author:string>>>, title string, "
    "entry array<struct<title:string,link:array<struct<_href:string,_rel:string>>,id:string,published:string,updated:string,summary:string,content:string,author:struct<name:string>>>"
)


@reader
def rss(payloads: DataFrame) -> DataFrame:
    """Feeds, RSS 2.0 or Atom."""
    address = lambda e: F.get(F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"]
    item = lambda i: F.struct(i["title"].alias("title"), i["link"].alias("link"), i["guid"].alias("guid"), i["pubDate"].alias("at"), i["description"].alias("description"), i["author"].alias("author"))
    entry = lambda e: F.struct(e["title"].alias("title"), address(e).alias("link"), e["id"].alias("guid"), F.coalesce(e["published"], e["updated"]).alias("at"), F.coalesce(e["summary"], e["content"]).alias("description"), e["author"]["name"].alias("author"))
    both = F.coalesce(F.transform("__doc.channel.item", item), F.transform("__doc.entry", entry))
    doc = F.from_xml("body", f"{FEED}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    empty = F.when(F.col("__doc.channel").isNotNull() | F.col("__doc.title").isNotNull(), F.array())
    rows = opened(payloads, doc, lambda _: F.coalesce(both, empty.cast("array<struct<title:string,link:string,guid:string,at:string,description:string,author:string>>")), F.col(f"__doc.{CORRUPT}").isNotNull() | F.col("__doc").isNull())
    return collected(rows, "rss", title=F.col("r.title"), url=F.trim("r.link"), external_id=F.col("r.guid"), description=clean_text(F.col("r.description")), author=blank_null(F.col("r.author")), published_at=dates.parse_published(F.col("r.at")), journal=F.coalesce("__doc.channel.title", "__doc.title"), raw_payload=F.to_json("r"))


@reader
def pubmed(payloads: DataFrame) -> DataFrame:
    """Citation records in XML, read by path: a record may hold several abstract parts and authors."""
    found = F.regexp_extract_all("body", F.lit(r"(?s)(<PubmedArticle\b.*?</PubmedArticle>)"), 1)
    whole = F.contains(F.col("body"), F.lit("</PubmedArticleSet>"))  # a set may be empty; one that is cut off isn't whole
    listed = F.when((F.size(found) > 0) | whole, found)
    articles = opened(payloads, F.lit(None).cast("string"), lambda _: listed, F.lit(True)).withColumnRenamed("r", "x")
    at = lambda path: F.get(F.xpath("x", F.lit(f"PubmedArticle/{path}/text()")), F.lit(0))
    year = F.coalesce(at("MedlineCitation//PubDate/Year"), F.substring(at("MedlineCitation//PubDate/MedlineDate"), 1, 4))
    month, day = dates.month_number(at("MedlineCitation//PubDate/Month")), at("MedlineCitation//PubDate/Day")
    families, given = F.xpath("x", F.lit("PubmedArticle/MedlineCitation/Article/AuthorList/Author[LastName]/LastName/text()")), F.xpath("x", F.lit("PubmedArticle/MedlineCitation/Article/AuthorList/Author[LastName]/ForeName/text()"))
    authors = F.transform(families, lambda f, i: F.struct(f.alias("family"), F.get(given, i).alias("given")))
    pmid = at("MedlineCitation/PMID")
    abstract = F.array_join(F.xpath("x", F.lit("PubmedArticle/MedlineCitation/Article//AbstractText//text()")), " ")
    title = F.array_join(F.xpath("x", F.lit("PubmedArticle/MedlineCitation/Article/ArticleTitle//text()")), "")
    return collected(articles, "pubmed", title=title, url=F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")), external_id=pmid, description=blank_null(abstract), authors_json=authors, published_at=dates.from_parts(year, month, day), doi=normalize_doi(at("/ArticleId[@IdType='doi']")), journal=at("MedlineCitation/Article/Journal/Title"), raw_payload=F.to_json(F.struct(pmid.alias("pmid"), at("/ArticleId[@IdType='pmc']").alias("pmcid"))))


@reader
def europepmc(payloads: DataFrame) -> DataFrame:
    rows = exploded(
        payloads,
        "resultList struct<result:array<struct<id:string,source:string,title:string,pmid:string,pmcid:string,doi:string,abstractText:string,fullText:string,journalTitle:string,isOpenAccess:string,firstPublicationDate:string,pubYear:string,authorList:struct<author:array<struct<lastName:string,collectiveName:string,firstName:string>>>,fullTextUrlList:struct<fullTextUrl:array<struct<url:string>>>>>>",
        lambda d: d["resultList"]["result"],
    )
    r, doi = F.col("r"), normalize_doi(F.col("r.doi"))
    authors = F.filter(F.transform(r["authorList"]["author"], lambda a: F.struct(F.coalesce(a["lastName"], a["collectiveName"]).alias("family"), a["firstName"].alias("given"))), lambda a: a["family"].isNotNull())
    url = F.coalesce(F.concat(F.lit("https://europepmc.org/article/MED/"), r["pmid"]), F.concat(F.lit("https://europepmc.org/article/PMC/"), r["pmcid"]), doi_url(doi), F.get(r["fullTextUrlList"]["fullTextUrl"], F.lit(0))["url"])
    return collected(rows, "europepmc", title=r["title"], url=url, external_id=F.coalesce(r["pmid"], r["pmcid"]), description=blank_null(r["abstractText"]), content_body=blank_null(r["fullText"]), authors_json=authors, published_at=dates.parse_published(F.coalesce(r["firstPublicationDate"], r["pubYear"])), doi=doi, journal=r["journalTitle"], open_access=F.coalesce(r["isOpenAccess"] == "Y", F.lit(False)), raw_payload=F.to_json(r))


@reader
def openalex(payloads: DataFrame) -> DataFrame:
    rows = exploded(
        payloads,
        "results array<struct<id:string,title:string,doi:string,publication_date:string,authorships:array<struct<author:struct<display_name:string>>>,primary_location:struct<landing_page_url:string,pdf_url:string,source:struct<display_name:string>>,open_access:struct<is_oa:boolean>,best_oa_location:struct<pdf_url:string,landing_page_url:string>,abstract_inverted_index:map<string,array<int>>,cited_by_count:long>>",
        lambda d: d["results"],
    )
    r, doi = F.col("r"), normalize_doi(F.col("r.doi"))
    authors = names(F.transform(r["authorships"], lambda a: F.struct(a["author"]["display_name"].alias("name"))))
    return collected(rows, "openalex", title=r["title"], url=first(r["primary_location"]["landing_page_url"], r["primary_location"]["pdf_url"], doi_url(doi)), external_id=r["id"], description=abstract_from_index(r["abstract_inverted_index"]), authors_json=authors, published_at=dates.parse_published(r["publication_date"]), doi=doi, journal=r["primary_location"]["source"]["display_name"], open_access=r["open_access"]["is_oa"], engagement=F.to_json(F.struct(F.coalesce(r["cited_by_count"], F.lit(0)).alias("cited_by_count"))), raw_payload=F.to_json(r))


@reader
def semanticscholar(payloads: DataFrame) -> DataFrame:
    rows = exploded(payloads, "data array<struct<paperId:string,title:string,url:string,externalIds:struct<DOI:string>,authors:array<struct<name:string>>,publicationDate:string,year:int,openAccessPdf:struct<url:string>,abstract:string,venue:string,isOpenAccess:boolean,citationCount:long>>", lambda d: d["data"])
    r, doi = F.col("r"), normalize_doi(F.col("r.externalIds.DOI"))
    abstract = blank_null(r["abstract"])
    return collected(rows, "semanticscholar", title=r["title"], url=first(r["url"], doi_url(doi)), external_id=r["paperId"], description=F.nullif(abstract, F.lit(NO_ABSTRACT)), authors_json=names(r["authors"]), published_at=F.coalesce(dates.parse_published(r["publicationDate"]), dates.from_parts(r["year"])), doi=doi, journal=blank_null(r["venue"]), open_access=r["isOpenAccess"], engagement=F.to_json(F.struct(F.coalesce(r["citationCount"], F.lit(0)).alias("citation_count"))), raw_payload=F.to_json(r))


@reader
def crossref(payloads: DataFrame) -> DataFrame:
    """A Creative Commons licence says open access; without one it is not known."""
    date = "struct<`date-parts`:array<array<int>>>"
    rows = exploded(payloads, f"message struct<items:array<struct<title:array<string>,DOI:string,URL:string,author:array<struct<family:string,given:string>>,published:{date},`published-print`:{date},`published-online`:{date},`container-title`:array<string>,abstract:string,license:array<struct<URL:string>>,link:array<struct<URL:string,`content-type`:string>>>>>", lambda d: d["message"]["items"])
    r, doi = F.col("r"), normalize_doi(F.col("r.DOI"))
    parts = F.get(F.coalesce(r["published"], r["published-print"], r["published-online"])["date-parts"], F.lit(0))
    free = F.coalesce(F.exists(r["license"], lambda x: F.contains(x["URL"], F.lit("creativecommons.org"))), F.lit(False))
    pdf = F.get(F.filter(r["link"], lambda x: x["content-type"] == "application/pdf"), F.lit(0))["URL"]
    url = first(r["URL"], doi_url(doi))
    return collected(rows, "crossref", title=F.get(r["title"], F.lit(0)), url=url, external_id=doi, description=blank_null(r["abstract"]), authors_json=F.filter(r["author"], lambda a: F.coalesce(a["family"], F.lit("")) != ""), published_at=dates.from_date_parts(parts), doi=doi, journal=F.get(r["container-title"], F.lit(0)), open_access=F.when(free, True), raw_payload=F.to_json(F.struct(r.alias("work"), F.when(free, F.coalesce(pdf, url)).alias("fetch_url"))))


@reader
def biorxiv(payloads: DataFrame) -> DataFrame:
    """Preprints whose title or abstract holds the configured words; config has query and server."""
    rows = exploded(payloads, "collection array<struct<title:string,abstract:string,doi:string,date:string,published:string,authors:string>>", lambda d: d["collection"])
    r, doi = F.col("r"), F.nullif(normalize_doi(F.col("r.doi")), F.lit(""))
    query = F.lower(F.coalesce(F.get_json_object("config", "$.query"), F.lit("")))
    hit = F.contains(F.lower(F.coalesce(r["title"], F.lit(""))), query) | F.contains(F.lower(F.coalesce(r["abstract"], F.lit(""))), query)
    author = blank_null(F.split_part(F.split_part(r["authors"], F.lit(";"), F.lit(1)), F.lit(","), F.lit(1)))
    return collected(rows.where(unread(hit)), "biorxiv", title=r["title"], url=doi_url(doi), external_id=doi, description=blank_null(r["abstract"]), author=author, published_at=dates.parse_published(F.coalesce(r["date"], r["published"])), doi=doi, journal=F.coalesce(F.get_json_object("config", "$.server"), F.lit("medrxiv")), open_access=F.lit(True), raw_payload=F.to_json(r))


@reader
def doaj(payloads: DataFrame) -> DataFrame:
    rows = exploded(payloads, "results array<struct<id:string,bibjson:struct<title:string,identifier:array<struct<type:string,id:string>>,link:array<struct<type:string,url:string>>,author:array<struct<name:string>>,year:string,journal:struct<title:string>,abstract:string>>>", lambda d: d["results"])
    b = F.col("r.bibjson")
    doi = normalize_doi(F.get(F.filter(b["identifier"], lambda x: x["type"] == "doi"), F.lit(0))["id"])
    text = F.get(F.filter(b["link"], lambda x: x["type"] == "fulltext"), F.lit(0))["url"]
    return collected(rows, "doaj", title=b["title"], url=first(doi_url(doi), text, F.concat(F.lit("https://doaj.org/article/"), F.col("r.id"))), external_id=F.col("r.id"), description=blank_null(b["abstract"]), authors_json=names(b["author"]), published_at=dates.from_parts(b["year"]), doi=doi, journal=b["journal"]["title"], open_access=F.lit(True), raw_payload=F.to_json("r"))


@reader
def clinicaltrials(payloads: DataFrame) -> DataFrame:
    rows = exploded(payloads, "studies array<struct<protocolSection:struct<identificationModule:struct<nctId:string,briefTitle:string,officialTitle:string>,descriptionModule:struct<briefSummary:string,detailedDescription:string>,statusModule:struct<startDateStruct:struct<date:string>>,sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string>>>>>", lambda d: d["studies"])
    p = F.col("r.protocolSection")
    who, what = p["identificationModule"], p["descriptionModule"]
    return collected(rows, "clinicaltrials", title=first(who["officialTitle"], who["briefTitle"]), url=F.concat(F.lit("https://clinicaltrials.gov/study/"), blank_null(who["nctId"])), external_id=who["nctId"], description=blank_null(what["briefSummary"]), content_body=blank_null(what["detailedDescription"]), author=p["sponsorCollaboratorsModule"]["leadSponsor"]["name"], published_at=dates.parse_published(p["statusModule"]["startDateStruct"]["date"]), open_access=F.lit(True), raw_payload=F.to_json(p))


@reader
def core(payloads: DataFrame) -> DataFrame:
    rows = exploded(payloads, "results array<struct<id:string,title:string,doi:string,downloadUrl:string,sourceFulltextUrls:array<string>,authors:array<struct<name:string>>,publishedDate:string,yearPublished:string,fullText:string,abstract:string,journals:array<struct<title:string>>>>", lambda d: d["results"])
    r, doi = F.col("r"), normalize_doi(F.col("r.doi"))
    text = F.trim(r["fullText"])
    url = first(r["downloadUrl"], F.get(r["sourceFulltextUrls"], F.lit(0)), doi_url(doi), F.concat(F.lit("https://core.ac.uk/works/"), r["id"]))
    return collected(rows, "core", title=r["title"], url=url, external_id=r["id"], description=blank_null(r["abstract"]), content_body=F.when(F.length(text) >= 200, text), authors_json=names(r["authors"]), published_at=dates.parse_published(first(r["publishedDate"], r["yearPublished"])), doi=doi, journal=F.get(r["journals"], F.lit(0))["title"], open_access=F.lit(True), raw_payload=F.to_json(r))


@reader
def wikipedia(payloads: DataFrame) -> DataFrame:
    """Summaries with the extract of the whole article in column extract; config has the asked title."""
    rows = single(payloads, "type string, title string, extract string, timestamp string, pageid long", "r")
    rows = rows.where(unread(~F.col("r.type").eqNullSafe(F.lit("disambiguation"))))
    asked = F.get_json_object("config", "$.title")
    return collected(rows, "wikipedia", title=F.coalesce(F.col("r.title"), asked), url=F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace(asked, F.lit(" "), F.lit("_"))), external_id=F.col("r.pageid"), description=blank_null(F.col("r.extract")), content_body=F.when(F.length("extract") > 300, F.col("extract")), published_at=dates.parse_published(F.col("r.timestamp")), open_access=F.lit(True), raw_payload=F.col("body"))


@reader
def hackernews(payloads: DataFrame) -> DataFrame:
    """Stories of at least the configured points."""
    rows = exploded(payloads, "hits array<struct<title:string,url:string,objectID:string,created_at_i:long,story_text:string,author:string,points:long,num_comments:long>>", lambda d: d["hits"])
    r = F.col("r")
    least = F.coalesce(F.get_json_object("config", "$.min_points").try_cast("long"), F.lit(5))
    return collected(rows.where(unread(F.coalesce(r["points"], F.lit(0)) >= least)), "hackernews", title=r["title"], url=first(r["url"], F.concat(F.lit("https://news.ycombinator.com/item?id="), r["objectID"])), external_id=r["objectID"], description=blank_null(r["story_text"]), author=r["author"], published_at=F.timestamp_seconds(r["created_at_i"]), engagement=F.to_json(F.struct(F.coalesce(r["points"], F.lit(0)).alias("points"), F.coalesce(r["num_comments"], F.lit(0)).alias("num_comments"))), raw_payload=F.to_json(r))


@reader
def youtube(payloads: DataFrame, statistics: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Search hits with their view counts (id, view_count) and transcripts (id, text); config has min_views."""
    rows = exploded(payloads, "items array<struct<id:struct<videoId:string>,snippet:struct<title:string,description:string,channelTitle:string,publishedAt:string>>>", lambda d: d["items"])
    rows = rows.withColumn("id", F.col("r.id.videoId")).where(unread(F.col("id") != "")).join(statistics.select("id", "view_count"), "id", "left").join(transcripts.select("id", "text"), "id", "left")
    least = F.coalesce(F.get_json_object("config", "$.min_views").try_cast("long"), F.lit(0))
    s = F.col("r.snippet")
    return collected(rows.where(unread(F.coalesce("view_count", F.lit(0)) >= least)), "youtube", title=s["title"], url=F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("id")), external_id=F.col("id"), description=blank_null(s["description"]), content_body=blank_null(F.col("text")), author=s["channelTitle"], published_at=dates.parse_published(s["publishedAt"]), engagement=F.to_json(F.struct(F.coalesce("view_count", F.lit(0)).alias("view_count"))), raw_payload=F.to_json("r"))


@reader
def newsapi(payloads: DataFrame) -> DataFrame:
    rows = exploded(payloads, "articles array<struct<title:string,url:string,source:struct<name:string>,author:string,description:string,content:string,publishedAt:string>>", lambda d: d["articles"])
    r = F.col("r")
    good = F.coalesce(F.get_json_object("body", "$.status") == "ok", F.lit(False))
    return collected(rows.where(unread(good & (F.coalesce(F.trim(r["title"]), F.lit("")) != "[Removed]"))), "newsapi", title=r["title"], url=F.trim(r["url"]), description=blank_null(r["description"]), content_body=blank_null(r["content"]), author=blank_null(r["author"]), published_at=dates.parse_published(r["publishedAt"]), journal=r["source"]["name"], raw_payload=F.to_json(r))


def page_items(payloads: DataFrame, source: str, title_tag: bool) -> DataFrame:
    """Saved pages (url, body): title and more from structured data, then from meta tags; the body from the page's text."""
    rows = payloads.withColumns({"ld": html.extract_json_ld(F.col("body")), "meta": html.extract_meta(F.col("body"), title_tag), "heads": html.extract_by_selectors(F.col("body"), {"h1": "h1", "title": "title"}), "article": html.extract_body(F.col("body"))})
    title = first(F.col("ld.title"), F.col("meta.title"), F.col("heads.h1"), F.col("heads.title"))
    return collected(rows, source, title=title, url=F.col("url"), description=clean_text(first(F.col("ld.description"), F.col("meta.description"))), content_body=first(F.col("article"), F.col("ld.body")), author=F.col("ld.author"), published_at=dates.parse_published(first(F.col("ld.published"), F.col("meta.published"))), journal=F.col("meta.site"))


@reader
def html_pages(payloads: DataFrame) -> DataFrame:
    return page_items(payloads, "html_pages", False)


@reader
def browser_pages(payloads: DataFrame) -> DataFrame:
    """Pages as a browser saved them; block and error pages are left out by their titles."""
    from millrace.functions.text import is_no_content_title

    found = page_items(payloads, "browser_pages", True)
    return found.where(F.col(REJECT).isNotNull() | ~is_no_content_title(F.col("title")))


@reader
def sitemap(payloads: DataFrame) -> DataFrame:
    return page_items(payloads, "sitemap", True)


def sitemap_urls(sitemaps: DataFrame, filter_path: str | None = None) -> DataFrame:
    """(url, kind, position) of sitemap documents: pages whose path holds filter_path, and sitemaps of an index, which are not filtered."""
    locs = lambda tag: F.regexp_extract_all("body", F.lit(rf"(?s)<{tag}>\s*<loc>\s*(.*?)\s*</loc>"), 1)
    each = sitemaps.select(F.posexplode(F.concat(F.transform(locs("url"), lambda u: F.struct(u.alias("url"), F.lit("page").alias("kind"))), F.transform(locs("sitemap"), lambda u: F.struct(u.alias("url"), F.lit("sitemap").alias("kind"))))).alias("position", "x"))
    out = each.select(F.col("x.url").alias("url"), F.col("x.kind").alias("kind"), "position")
    return out if filter_path is None else out.where((F.col("kind") == "sitemap") | F.contains(urls.url_path(F.col("url")), F.lit(filter_path)))


@reader
def nhs_api(payloads: DataFrame) -> DataFrame:
    rows = payloads.withColumns({"at": html.extract_by_selectors(F.col("body"), {"h1": "h1", "title": "title"}), "meta": html.extract_meta(F.col("body"), True), "article": html.extract_body(F.col("body"), ("#maincontent", "main", ".nhsuk-main-wrapper", "article", "[role='main']"))})
    reviewed = F.regexp_extract(F.regexp_replace("body", "<[^>]+>", " "), r"Page last reviewed:\s*(\d{1,2}\s+\w+\s+\d{4})", 1)
    return collected(rows, "nhs_api", title=F.regexp_replace(first(F.col("at.h1"), F.col("at.title")), r"\s*-\s*NHS\s*$", ""), url=F.col("url"), external_id=F.regexp_replace(urls.url_path(F.col("url")), "^/+|/+$", ""), description=clean_text(F.col("meta.description")), content_body=F.col("article"), author=F.lit("NHS"), published_at=F.try_to_timestamp(reviewed, F.lit("d MMMM yyyy")), journal=F.lit("nhs.uk"), open_access=F.lit(True))


@reader
def cdc_data(payloads: DataFrame) -> DataFrame:
    """Datasets: body is the metadata, rows the saved rows; one item each, with the first rows as text."""
    rows = single(payloads, "id string, name string, description string, viewCount long", "m")
    rows = rows.withColumn("table", F.from_json("rows", "array<map<string,string>>"))
    has = F.size("table") > 0
    body = F.when(has, F.concat(F.lit("Dataset: "), F.col("m.name"), F.lit("\n\n"), tabular_text(F.col("table"))))
    return collected(rows, "cdc_data", title=F.col("m.name"), url=F.concat(F.lit("https://data.cdc.gov/dataset/"), F.col("m.id")), external_id=F.col("m.id"), description=F.substring(blank_null(F.col("m.description")), 1, 1000), content_body=body, author=F.lit("CDC"), journal=F.lit("data.cdc.gov"), open_access=F.lit(True), engagement=F.to_json(F.struct(F.when(has, F.size("table").cast("long")).otherwise(F.coalesce("m.viewCount", F.lit(0))).alias("row_count"), F.when(has, F.coalesce("m.viewCount", F.lit(0))).alias("view_count"))))


@reader
def link_harvester(items: DataFrame, body: str = "content_body") -> DataFrame:
    """Stubs of the papers that stored texts refer to."""
    from millrace.functions.text import references

    each = items.select(F.explode(references(F.col(body))).alias("r"))
    return collected(each, "link_harvester", title=F.col("r.title"), url=F.col("r.url"), external_id=F.col("r.stub_id"), doi=F.when(F.col("r.kind") == "doi", F.col("r.raw_id")), engagement=F.lit("{}"), raw_payload=F.to_json(F.struct(F.col("r.kind").alias("stub_type"), F.col("r.raw_id").alias("raw_id")))).dropDuplicates(["external_id"])


@reader
def link_harvester_backfill(stubs: DataFrame, records: DataFrame) -> DataFrame:
    """Stubs (id, external_id) with the records (external_id, title, description, ...) of the service their type belongs to."""
    kind = F.split_part("external_id", F.lit(":"), F.lit(1))
    return stubs.select("id", "external_id", kind.alias("stub_type")).join(records, "external_id")


def read(platform: str, payloads: DataFrame, *more: DataFrame) -> DataFrame:
    if platform not in READERS:
        raise ValueError(f"no reader for {platform}")
    return READERS[platform](payloads, *more)


REJECTS = "platform string, surface_key string, seq long, reason string, record int, raw string"


def marked(platform: str, payloads: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows of a reader: items, and with REJECT set what is none."""
    if platform not in READERS:
        raise ValueError(f"no reader for {platform}")
    rows = READERS[platform].marked(payloads, *more)
    return rows if REJECT in rows.columns else rows.withColumn(REJECT, F.lit(None).cast("struct<reason:string,raw:string,record:int>"))


def sorted_out(rows: DataFrame, platform: str) -> tuple[DataFrame, DataFrame]:
    """(items, rejects) of marked rows; rejects have the columns of REJECTS. Write or persist the rows first, so both come from one pass."""
    along = [F.col(c) if c in rows.columns else F.lit(None).cast("string" if c == "surface_key" else "long").alias(c) for c in CARRIED]
    rejects = rows.where(F.col(REJECT).isNotNull()).select(F.lit(platform).alias("platform"), *along, f"{REJECT}.reason", f"{REJECT}.record", f"{REJECT}.raw")
    return rows.where(F.col(REJECT).isNull()).drop(REJECT), rejects
