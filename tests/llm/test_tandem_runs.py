"""Periodic runs against a plain version, and on odd tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import queries as q
from millrace.llm import tandem_runs as t


def plain_runs(codes, least=6, times=4):
    """Every maximal stretch of every period, but those whose words have a lesser period."""
    out, n = [], len(codes)
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and codes[j] == codes[j + period]:
                j += 1
            length = j + period - i
            if j > i and length >= max(least, times * period):
                s = codes[i : j + period]
                if not any(s[p:] == s[:-p] for p in range(1, period)):
                    out.append((i, length, period))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def drawn(draw, most=60):
    kinds = draw.choice([1, 2, 3, 5])
    out = [draw.randrange(kinds) for _ in range(draw.randrange(most))]
    for _ in range(draw.randrange(3)):
        root = [draw.randrange(kinds) for _ in range(draw.randrange(1, 8))]
        at = draw.randrange(len(out) + 1)
        out[at:at] = (root * 12)[: draw.randrange(4, 60)]
    return out


def plain_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def plain_row(doc_id, text):
    words = plain_words(doc_id, text or "")
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def test_all_squares_make_the_runs():
    """Runs from two periods on: every square of the vocabulary counts."""
    draw = random.Random(1)
    for _ in range(1500):
        codes = drawn(draw)
        got = [tuple(r) for r in t.all_runs(np.array([*codes, 99]), len(codes) + 1, 2, 2).tolist()]
        assert got == plain_runs(codes, 2, 2), codes


def test_vocabulary_is_complete():
    """The points of the tree are the different squares with a root that is no repetition."""
    draw = random.Random(2)
    for _ in range(300):
        codes = np.array([*drawn(draw, 40), 9], np.int64)
        s = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        ranks = t.Ranks(s, len(s))
        order = np.argsort(ranks.ranks[-1], kind="stable")
        assert [tuple(s[i:]) for i in order] == sorted(tuple(s[i:]) for i in range(len(s)))
        start, root = t.covering_squares(ranks, t.block_starts(ranks, order))
        good = t.primitive(ranks, start, root)
        tree = t.Tree(s, ranks, order)
        node, size = tree.vocabulary(start[good], root[good])
        got = sorted(tuple(s[i : i + 2 * k]) for i, k in zip(order[tree.low[node]], size)) if len(node) else []
        every = {tuple(s[i : i + 2 * k]) for k in range(1, len(s) // 2 + 1) for i in range(len(s) - 2 * k + 1) if (s[i : i + k] == s[i + k : i + 2 * k]).all()}
        bare = {x for x in every if not any(len(x) // 2 % d == 0 and x[d:] == x[:-d] for d in range(1, len(x) // 2))}
        assert got == sorted(bare)


def test_stretches_lose_no_run():
    draw = random.Random(3)
    for _ in range(600):
        texts = [drawn(draw) for _ in range(draw.randrange(5))]
        got = [[tuple(r) for r in x.tolist()] for x in t.text_runs([np.array(x, np.int64) for x in texts])]
        assert got == [plain_runs(x) for x in texts], texts


ODD = [
    (0, ""), (1, " \n\t"), (2, "a"), (None, None), (3, None), (None, "x x x x x x x"), (4, "la " * 5), (5, "la " * 6), (5, "la " * 6),
    (6, "a b c " * 4), (7, "a b c " * 3 + "a b"), (8, "a\x0bb\x0cc\rd e\x1cf\x85g " * 9), (9, "x " + "p q " * 4 + "p z " + "u v w x " * 5), (10, "na na na na na na hey " * 8),
]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_rows(spark):
    # ids enough that some are planted in, and texts that hold runs of their own
    draw = random.Random(4)
    more = [(i, " ".join("w%d" % w for w in drawn(draw))) for i in range(100, 300)]
    docs = spark.createDataFrame([(i, x, "x", 1) for i, x in ODD + more], "doc_id long, text string, runs string, period int")
    assert sum(zlib.crc32(b"%d" % i) % 10 == 0 for i, _ in more) > 10
    got = t.digest(t.find_runs(docs, plant=True))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(got) == [plain_row(i, x) for i, x in ODD + more]
    assert rows_of(t.digest(t.find_runs(docs.limit(0)))) == []
    plain = {r["doc_id"]: r["collapsed"] for r in t.find_runs(docs).collect()}
    assert plain[6] == "a b c" and plain[5] == "la" and plain[4] == "la la la la la"


def test_query_on_whole_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    short = {r["doc_id"] for r in texts if len(r["text"] or "") < 6000}
    assert len(short) > 100
    want = {plain_row(r["doc_id"], r["text"]) for r in texts if r["doc_id"] in short}
    got = set(rows_of(q.op12_tandem_runs(spark, folder)))
    assert len(got) == len(texts) and {r for r in got if r[0] in short} == want


@pytest.mark.parametrize("name", ["one", "fibonacci", "period"])
def test_very_long_texts(name):
    if name == "one":
        codes = [0] * 300_000
    elif name == "period":
        codes = np.random.default_rng(1).integers(0, 50, 1000).tolist() * 100
    else:
        a, codes = [0], [0, 1]
        while len(codes) < 100_000:
            a, codes = codes, codes + a
    (runs,) = t.text_runs([np.array(codes, np.int64)])
    assert runs.tolist() == {"one": [[0, 300_000, 1]], "fibonacci": [], "period": [[0, 100_000, 1000]]}[name]
