"""Spelling variants against a plain version, in crowds, and on odd tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import queries as q
from millrace.llm import spelling_variants as v


def plain_words(rows):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                words[w] += 1
    return {w: n for w, n in words.items() if n >= 2}


def plain_near(words):
    """By all strings that one deletion gives: two words with a common one are a deletion, or a replacement at one place, apart."""
    near, shorter = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add((w, i))
    for w in words:
        for x, _ in shorter.get(w, ()):
            near[w].add(x)
            near[x].add(w)
    for same in shorter.values():
        by_place = defaultdict(set)
        for w, i in same:
            by_place[i].add(w)
        for group in by_place.values():
            for a in group:
                near[a] |= group - {a}
    return near


def plain(rows):
    words = plain_words(rows)
    near, form, out = plain_near(words), {}, {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def result(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = q.op11_spelling_variants(spark, folder)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = result(found)
    assert got == plain(rows) and sum(x[3] for x in got.values()) > 1000


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert result(v.spelling_variants(spark, docs, crowd=60, shard=3000)) == want
    assert sum(x[0] is not None for x in want.values()) > 100


@pytest.mark.parametrize("crowd, shard", [(20, 100), (20_000, 60_000)])
def test_crowded_halves(spark, crowd, shard):
    """A third of the words share their first half, as many the second; many differ in one place only."""
    draw = random.Random(1)
    pick = lambda n, of="abcé": "".join(draw.choice(of) for _ in range(n))
    words = {"common" + pick(draw.randrange(5, 8)) for _ in range(300)} | {pick(draw.randrange(5, 8)) + "ending" for _ in range(300)}
    words |= {pick(draw.randrange(7, 10), "ab") for _ in range(300)} | {"aaaaaaa" + "a" * k for k in range(30)}
    words |= {f"stem{c}words" for c in "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîï×÷ÿ"}
    weight = {w: 2 * 10 ** draw.randrange(3) for w in words}
    weight["stemawords"] = 30_000
    rows = [(k, " ".join(f"{w}," for w in words for _ in range(weight[w] // 2))) for k in range(2)]
    assert result(v.spelling_variants(spark, frame(spark, rows), crowd=crowd, shard=shard)) == plain(rows)


def test_chains_lead_to_their_last_form(spark):
    rows = [(1, "lettersa " * 2000 + "lettersb " * 200 + "lettersbc " * 20 + "lettersbcd " * 2 + "LETTERSBCD! " * 0), (2, "lettersz " * 199)]
    got = result(v.spelling_variants(spark, frame(spark, rows)))
    assert got == plain(rows) and {got[w][1] for w in ("lettersbcd", "lettersbc", "lettersb", "lettersa")} == {"lettersa"}


def test_odd_tables(spark):
    long = "ab" * 1000
    rows = [
        (None, "Nameless NAMELESS namelesÉ"), (None, None), (1, ""), (1, None), (2, "ÀÁÂÃÄÅÆ àáâãäåæ àáâãäåæ ÀÁÂÃÄÅÆ"), (3, f"{long} {long}"), (4, f"{long}a {long}a {long}a"),
        (5, "seven77seven sevenxx sevenxx"), (5, "seven77seven sevenxx sevenxx"), (6, "naïveté×÷ÿ naïveté×÷ÿ İstanbul İstanbul Kelvins Kelvins"),
    ]
    rows += [(k, "dropped letters somewhere") for k in range(10, 200)]
    assert result(v.spelling_variants(spark, frame(spark, rows))) == plain(rows)
    assert v.spelling_variants(spark, frame(spark, [])).collect() == []


def test_very_long_words(spark):
    long = "ab" * 100_000
    rows = [(3, f"{long} {long}"), (4, f"{long}a {long}a {long}a"), (5, f"c{long} c{long}")]
    got = result(v.spelling_variants(spark, frame(spark, rows)))
    assert {w: x[2:4] for w, x in got.items()} == {long: (2, 2), f"{long}a": (3, 1), f"c{long}": (2, 1)}


def test_words_are_passed_on_while_counting(spark, monkeypatch):
    rows = [(k, f"counting{chr(97 + k % 26)} repeated") for k in range(200)]
    monkeypatch.setattr(v, "HELD", 5)  # local tests fork their workers: they see it
    got = {r["word"]: r["n"] for r in v.count_words(frame(spark, rows).repartition(3)).collect()}
    assert {w: n for w, n in got.items() if n >= 2} == plain_words(rows)
