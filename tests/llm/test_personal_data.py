"""Personal data against a plain version, against DuckDB, and on odd tables."""

import hashlib
import random
import re
import time

import duckdb
import pytest

from millrace.llm import personal_data as p

PARTS = [
    "a", "Z", " ", "\n", "@", ".", "b.co", "1", "4111111111111111", "12", "+", "-", "(", "é", "😀", "255", "0.0.0.0", "ssn", "card", "_", "%",
    "IBAN ", "version", "9", "00", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "123-45-6789", "000-45-6789", "+44 20 7946 0958",
]


def luhn(digits: str) -> bool:
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base(text: str) -> list[tuple[str, int, int]]:
    """The base kinds as the contract writes them."""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m.split("."))) <= 255),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    found = [(k, m.start(), m.end()) for k, (pattern, good) in kinds.items() for m in re.finditer(pattern, text) if good(m[0])]
    return sorted(found, key=lambda s: (s[1], list(kinds).index(s[0])))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, spans string, kind string")


@pytest.fixture(scope="module")
def fuzz():
    draw = random.Random(3)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(60))) for _ in range(1500)]
    return [*enumerate(texts), (None, None), (3, None), (None, "a@b.co"), (3, "a@b.co"), (3, "a@b.co"), (5, "")]


def test_base_kinds_and_sql_twin(spark, fuzz):
    docs = frame(spark, fuzz)
    got = p.digest(p.find_personal_data(docs)).collect()
    assert [r["doc_id"] for r in got] == [i for i, _ in fuzz]
    for r, (_, text) in zip(got, fuzz):
        want = base(text or "")
        assert [r[f"n_{k}"] for k in p.BASE] == [sum(s[0] == k for s in want) for k in p.BASE], text
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest(), text
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in p.BASE] == [s for s in written.split(",") if s]
    assert sum("iban" in r["spans"] for r in got) > 100 and sum("ssn" in r["spans"] for r in got) > 20
    duck = duckdb.connect()
    duck.register("documents", docs.select("doc_id", "text").toArrow())
    assert sorted(map(tuple, got), key=str) == sorted(duck.execute(p.oracle()).fetchall(), key=str)


def test_context_and_checksums(spark):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33"
    want = {
        f"IBAN {good} AND MORE, {bad}": [("iban", 5, 32, 100)],  # no further than its country's length
        f"x{good}": [],
        "123-45-6789": [],
        "my SSN: 123-45-6789.": [("ssn", 8, 19, 60)],
        **{f"ssn {x}": [] for x in ("000-45-6789", "666-45-6789", "123-00-6789", "123-45-0000", "1123-45-6789", "123-45-6789-1")},
        "host 10.0.0.1": [("ip", 5, 13, 80)],
        "the 10.0.0.1": [("ip", 4, 12, 50)],
        "version 10.0.0.1": [("ip", 8, 16, 20)],  # a low score removes no base span
        "Card" + " " * 60 + "4111111111111111": [("card", 64, 80, 60)],  # too far away
        "😀é a@b.co": [("email", 3, 9, 80)],
        "a@b.c_d@e.f": [("email", 0, 5, 80), ("email", 5, 11, 80)],
    }
    got = p.find_personal_data(frame(spark, enumerate(want))).collect()
    for r, (text, spans) in zip(got, want.items()):
        assert [tuple(s) for s in r["spans"]] == spans, text


def test_long_texts_take_time_by_their_length(spark):
    """Runs that make a backtracking matcher try every beginning, long chains, and very many matches."""
    texts = ["a" * 1_000_000, "1" * 1_000_000, "+" * 300_000 + "+1" + " " * 300_000, "a@" + "b." * 300_000, "1-" * 300_000, "a@b.co " * 100_000, "A1" * 300_000, "4111111111111111, " * 20_000]
    began = time.time()
    got = p.find_personal_data(frame(spark, enumerate(texts))).collect()
    assert time.time() - began < 60
    assert [len(r["spans"]) for r in got] == [0, 0, 0, 1, 0, 100_000, 0, 20_000]
    assert got[5]["spans"][-1]["end"] == 700_000 - 1 and got[7]["spans"][19_999]["start"] == 19_999 * 18


def test_empty_table_and_plan(spark):
    none = frame(spark, [])
    assert p.digest(p.find_personal_data(none)).collect() == []
    plan = p.find_personal_data(none)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
