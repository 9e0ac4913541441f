"""Counts in passing, and patterns by key."""

import json
import random
import re
import time

from millrace.operators.lifecycle import outcome_counts
from millrace.plans import views
from millrace.streaming import counters

ROWS = [("kept",)] * 5 + [("dropped",)] * 3 + [("odd",), (None,)]


def test_counts_in_passing(spark, tmp_path):
    batch = spark.createDataFrame(ROWS, "action string")
    rows, seen = counters.observed(batch, ["kept", "dropped", "failed"])
    rows.write.parquet(str(tmp_path / "out"))
    own = {r["action"]: r["n"] for r in outcome_counts(batch).collect()}
    assert seen.get == {"kept": own["kept"], "dropped": own["dropped"], "failed": 0, "other": own["odd"] + own[None]}


def test_lines_of_a_stream(spark, tmp_path):
    for k in range(2):
        spark.createDataFrame(ROWS[k:], "action string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    lines = []
    listener = counters.MetricLines(lines.append)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("action string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = counters.observed_stream(stream, ["kept", "dropped"]).writeStream.format("noop").queryName("pass").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        deadline = time.time() + 30
        while len(lines) < 2 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    got = [json.loads(x) for x in lines]
    assert sum(x["kept"] for x in got) == 9 and sum(x["dropped"] for x in got) == 6 and sum(x["other"] for x in got) == 4 and {x["name"] for x in got} == {"pass"}


def like(pattern: str) -> re.Pattern:
    return re.compile("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern), re.S)


def test_patterns_by_key(spark):
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abc./") for _ in range(n))
    urls = [f"https://{word(draw.randrange(1, 30))}" for _ in range(200)] + ["", "é😀é😀x", "ab"]
    patterns = [("%" + "%".join(word(draw.randrange(0, 7)) for _ in range(draw.randrange(1, 3))) + draw.choice(["%", "_", ""])) for _ in range(150)] + ["%", "", "é😀é_x", "https://%", "ab"]
    found = spark.createDataFrame([(k, u, "10.1/x", 1, ["t"]) for k, u in enumerate(urls)], "id long, oa_url string, doi string, authority_tier int, domain_tags array<string>")
    domains = spark.createDataFrame([(f"d{k}", p) for k, p in enumerate(patterns)], "domain string, pattern string")
    pairs = views.matched(found, domains)
    want = {(k, f"d{j}") for k, u in enumerate(urls) for j, p in enumerate(patterns) if like(p).fullmatch(u)}
    assert {(r["id"], r["domain"]) for r in pairs.select("id", "domain").collect()} == want and pairs.count() == len(want) > 500
    many = domains.unionByName(spark.range(views.MOST_PATTERNS + 1).selectExpr("concat('m', id) AS domain", "concat('%never', id, '%') AS pattern"))
    plan = views.manual_skips(found, many)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r["domain"]: r["total_matched"] for r in views.manual_skips(found, many).collect()}
    assert all(got[f"d{j}"] == sum(1 for x in want if x[1] == f"d{j}") for j in range(len(patterns)))
