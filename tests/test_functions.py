"""Cases for functions whose results no table here shows."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import chunking, dates, html, records, text, urls


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, v if not isinstance(v, (str, int, float, type(None), list)) else F.lit(v))
    return df.select(column.alias("x")).first()["x"]


SEED = "www.aap.org"


@pytest.mark.parametrize("url,want", [
    ("https://www.aap.org/en/donate/", False), ("https://www.aap.org/conditions/adhd", True), ("https://www.aap.org/", False), ("https://other.org/a/b", False), ("https://www.aap.org/a/b#overview", False),
    ("https://www.aap.org/english/pages/login.aspx", False), ("https://www.aap.org/english/health-issues/adhd.aspx", True), ("https://www.aap.org/mychart/some-page", False), ("https://www.aap.org/en/", False), ("https://www.aap.org/en/adhd", True),
    ("https://pubmed.ncbi.nlm.nih.gov/12345678", True), ("https://www.aap.org/x/johns-request-appointment", False), ("https://www.aap.org/blog/the-login-page-redesign-explained", True), ("https://www.aap.org/x/appointment-request-info", True), ("not a url", False),
])
def test_content_url(spark, url, want):
    assert one(spark, urls.is_content_url(F.col("u"), SEED, 2, ["pubmed.ncbi.nlm.nih.gov"]), u=url) is want


@pytest.mark.parametrize("url,want", [
    ("HTTPS://Ex.ORG/a/?utm_source=x&b=2&a=&b=3#f", "https://ex.org/a/?b=2&b=3"), ("https://ex.org/a///", "https://ex.org/a"), ("https://ex.org/?REF=1", "https://ex.org"), ("https://ex.org/p?q=a%20b", "https://ex.org/p?q=a+b"), ("", ""), (None, None), ("http://[bad", "http://[bad"),
])
def test_canonical(spark, url, want):
    assert one(spark, urls.normalize_url(F.col("u").cast("string")), u=url) == want


def test_canonical_of_many(spark):
    """Against the standard library's parser and encoder, on URLs put together at random."""
    import random
    from urllib.parse import parse_qsl, urlencode, urlsplit

    draw = random.Random(5)
    names, values = ["a", "b", "B", "utm_source", "ref", "x%20y", "é", "%41", "", "k*~"], ["1", "", "a+b", "%E2%82%AC", "100%", "x=y", "~*'", "ü", "%2F"]
    given = []
    for _ in range(400):
        query = "&".join(draw.choice([f"{draw.choice(names)}={draw.choice(values)}", draw.choice(names)]) for _ in range(draw.randrange(5)))
        given.append(f"{draw.choice(['HTTP', 'https'])}://{draw.choice(['Ex.org', 'a.B.com:80', 'u@h.net'])}{draw.choice(['', '/', '/P/q//', '/a;b'])}{draw.choice(['?', '']) if not query else '?'}{query}{draw.choice(['', '#f?g', '#'])}")

    def plain(url):
        parts = urlsplit(url)
        pairs = [(k, v) for k, v in parse_qsl(parts.query) if k.lower() not in urls.TRACKING]
        order = list(dict.fromkeys(k for k, _ in pairs))
        query = urlencode(sorted(pairs, key=lambda p: order.index(p[0])))
        return f"{parts.scheme.lower()}://{parts.netloc.lower()}{parts.path}{'?' + query if query else ''}".rstrip("/")

    rows = spark.createDataFrame([(u,) for u in given], "u string").select("u", urls.normalize_url(F.col("u")).alias("x")).collect()
    assert [(r["u"], r["x"]) for r in rows if r["x"] != plain(r["u"])] == []


@pytest.mark.parametrize("word,want", [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("formaliti", "formal"), ("triplicate", "triplic"), ("electrical", "electr"), ("goodness", "good"), ("revival", "reviv"), ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("sleeping", "sleep"), ("sleeps", "sleep"), ("a1b", "a1b"), ("", "")])
def test_stems(word, want):
    from millrace.functions.stem import stem

    assert stem(word) == want


@pytest.mark.parametrize("url,domain,want", [("https://www.cdc.gov/x", "cdc.gov", True), ("https://a.cdc.gov/x", "cdc.gov", True), ("https://notcdc.gov/", "cdc.gov", False), ("https://cdc.gov.evil.com/", "cdc.gov", False)])
def test_on_domain(spark, url, domain, want):
    assert one(spark, urls.on_domain(F.col("u"), domain), u=url) is want


@pytest.mark.parametrize("url,want", [("https://www.a.org/x", "a.org"), ("not a url", None), ("", None), ("http://who.int/", "who.int")])
def test_domain(spark, url, want):
    assert one(spark, urls.domain(F.col("u")), u=url) == want


@pytest.mark.parametrize("title,description,kind,platform,want", [
    ("A systematic review", None, "academic", "biorxiv", "systematic_review"), ("x", None, "reddit", "rss", "anecdotal"), ("x", None, "blog", "rss", "blog"), ("x", None, "academic", "biorxiv", "preprint"), ("x", None, None, "clinicaltrials", "clinical_trial"),
    ("x", None, "official_health", "nhs_api", "government_guidance"), ("x", None, "official_health", "rss", None), ("x", None, "hospital", "html_pages", "hospital_education"), ("x", "an RCT of y", "academic", "pubmed", "rct"), ("x", None, "academic", "pubmed", "peer_reviewed_study"), (None, None, None, None, None),
])
def test_evidence(spark, title, description, kind, platform, want):
    s = lambda v: F.lit(v).cast("string")
    assert one(spark, text.evidence_level(s(title), s(description), s(kind), s(platform))) == want


@pytest.mark.parametrize("raw,want", [("10.1038/xyz)", "10.1038/xyz"), ("10.1044/1058-0360(2012/10-0078)", "10.1044/1058-0360(2012/10-0078)"), ("a(b)c)d", "a(b)c"), ("", "")])
def test_unbalanced(spark, raw, want):
    assert one(spark, text.trim_unbalanced_paren(F.col("r")), r=raw) == want


@pytest.mark.parametrize("reason,before,want", [("http_404", 0, None), ("robots_blocked", 0, None), ("http_403", 0, "2024-03-02"), ("fetch_failed", 0, "2024-02-01"), ("fetch_failed", 4, None), ("odd", 0, None), (None, 0, None)])
def test_retry(spark, reason, before, want):
    now = F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")) if want == "2024-03-02" else F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00"))
    found = one(spark, F.date_format(records.next_retry(F.lit(reason).cast("string"), F.lit(before), now), "yyyy-MM-dd"))
    assert found == want


def test_replies(spark):
    good = '{"structured_output": {"results": [{"url": "u", "title": "t"}, {"url": "", "title": "x"}]}}'
    assert [(r["url"], r["title"]) for r in one(spark, records.candidates(F.col("r")), r=good)] == [("u", "t")]
    assert one(spark, records.candidates(F.col("r")), r='{"result": "{\\"results\\": [{\\"url\\": \\"u\\", \\"title\\": \\"t\\"}]}"}')[0]["url"] == "u"
    assert one(spark, records.candidates(F.col("r")), r="nonsense") == []
    said = '{"structured_output": {"tier": %s, "confidence": "%s", "reason": "%s", "source_type": "academic"}}'
    v = one(spark, records.verdict(F.col("r")), r=said % ("1", "high", "ok"))
    assert (v["tier"], v["confidence"]) == (1, "high")
    assert one(spark, records.verdict(F.col("r")), r=said % ("null", "low", "ok"))["tier"] is None
    for bad in (said % ("3", "high", "ok"), said % ("1", "sure", "ok"), said % ("1", "high", " "), "nonsense"):
        assert one(spark, records.verdict(F.col("r")), r=bad) is None


def test_captions_and_pdf(spark):
    srt = "1\n00:00:01,000 --> 00:00:02,000\n<i>one</i>\n\n2\n00:00:02,000 --> 00:00:03,000\none\n\n3\n00:00:03,000 --> 00:00:04,000\ntwo\n"
    assert one(spark, text.srt_to_text(F.col("s")), s=srt) == "one two"
    assert one(spark, text.srt_to_text(F.col("s")), s="") == ""
    assert one(spark, text.pdf_text(F.array(F.lit("a\n12\nb"), F.lit("c\nReferences\n[1] x")))) == "a b c"
    assert one(spark, text.title_from_pdf(F.lit("A fine title\nx"), F.lit("https://a/b.pdf"))) == "A fine title"
    assert one(spark, text.title_from_pdf(F.lit("no"), F.lit("https://a.org/my_file-1.PDF"))) == "my file 1"


def test_dates(spark):
    day = lambda c: one(spark, F.date_format(c, "yyyy-MM-dd"))
    assert day(dates.parse_published(F.lit("Tue, 05 Mar 2024 10:00:00 GMT"))) == "2024-03-05"
    assert day(dates.parse_published(F.lit("2024-03-05T10:00:00Z"))) == "2024-03-05"
    assert day(dates.parse_published(F.lit("rubbish"))) is None
    assert day(dates.from_date_parts(F.array(F.lit(2020), F.lit(7)))) == "2020-07-01"
    assert one(spark, dates.month_number(F.lit("Sep"))) == 9


def test_rates(spark):
    r = lambda a, b: one(spark, text.rate_per_second(F.lit(a).cast("string"), F.lit(b).cast("string")))
    assert (r("50", "1s"), r("60", "1m"), r("x", "1s"), r("5", "odd")) == (50.0, 1.0, None, None)
    assert one(spark, text.percent(F.lit(1), F.lit(3))) == "33%"
    assert one(spark, text.backoff_seconds(F.lit(9))) == 60.0


def test_chunker(spark):
    def chunked(text):
        return one(spark, chunking.chunks(F.col("t").cast("string")), t=text)

    assert chunked("") == chunked(None) == chunked(" \n\n ") == []
    para = " ".join(f"w{i}" for i in range(400))
    got = chunked("\n\n\n".join([para] * 3))
    assert len(got) == 3 and got[1].split()[:60] == got[0].split()[-60:]
    long = " ".join(f"x{i}" for i in range(900))
    assert chunked(para + "\n\n" + long) == [para, long]
    assert chunked(long + "\n\n" + "tiny end") == [long + " tiny end"]
    assert {w for c in got for w in c.split()} == set(para.split())


PAGE = """<html><head><title>T - NHS</title><meta property="og:title" content="OG"><meta name="description" content="D">
<script type="application/ld+json">[{"@type":"Thing","name":"no"},{"@type":"Article","headline":"LD","author":[{"name":"Ann"}]}]</script></head>
<body><nav><a href="/x">x</a></nav><main><h1>Head</h1><p>%s</p><h2>Two</h2><ul><li>item</ul></main></body></html>""" % ("word " * 80)


def test_html():
    assert html.body_of(PAGE).startswith("Head word word")
    assert html.body_of("") is None and html.body_of("<body>short</body>") == "short"
    assert html.json_ld_of(PAGE)["title"] == "LD" and html.json_ld_of(PAGE)["author"] == "Ann"
    assert html.meta_of(PAGE) == {"title": "OG", "description": "D", "published": None, "site": None}
    assert [s["heading"] for s in html.sections_of(PAGE)] == ["Head", "Two"]
    assert html.links_of(PAGE) == ["/x"]
    assert html.xml_text_of("<a>" + "<b>word</b> " * 80 + "</a>").startswith("word word") and html.xml_text_of("<a>") is None
