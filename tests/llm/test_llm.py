"""The training-data operators against plain versions, and on odd tables."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import brute
from millrace.llm import bpe, capture_index, decontamination, mpeg_audio, order_minhash, quality, secret_scan, sstable, token_count, url_filter
from millrace.llm import queries as q
from millrace.llm._common import PieceCache, work_path

FOLDER = "/root/testdata/sf0.001"
LONG = "".join(random.Random(5).choice("abcdefg thion") for _ in range(60_000))
TEXTS = ["", " ", "a", "Hello  world <s> \n é", "日本語 テキスト ▁x", "\x00\x1c\x85", "<|endoftext|> special", "it's a'b 12.5%!! --", "Σας ΣΑΣ İstanbul ǅ ß", "é combining", "tab\tand\r\nlines\n\n\n", "!?. odd, .marks", LONG, LONG.replace(" ", "")]
ODD = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (3, "Hello  world <s> \n é"), (7, None), (None, None)]
KIND = "doc_id long, text string, n_tokens string, ids string, score string, label string, digest string, media string"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long ones, repeated rows, and columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x") for i, t in ODD], KIND)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


def texts(spark, table="documents", key="doc_id", text="text"):
    return {r[key]: r[text] or "" for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").collect()}


def fuzz(n=2000):
    draw = random.Random(9)
    parts = ["a", "Z", " ", "\n", "the", "tion", "́", "é", "'s", "'re", "1", "23", "!", ".", ", ", "<|endoftext|>", "Σ", "ς", "İ", "日", "　", "\x1c", "▁", "😀", "Á"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 25))) for _ in range(n)]


# --- 1

def test_mpeg_round_trip(spark, odd, none):
    def rows(df):
        media = mpeg_audio.store_media(df)
        return mpeg_audio.read_media(media).collect()

    for r, (i, t) in zip(rows(odd), ODD):
        raw = (t or "").encode()
        assert (r["doc_id"], r["n_bytes"]) == (i, len(raw))
        assert r["payload"] == raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")
        assert r["crc_bad"] == r["skipped"] == 0 and r["frames"] == len(r["seek_offsets"]) and r["duration_samples"] == 1152 * r["frames"] and r["vbr"] == "Xing"
    assert rows(none) == []


def test_mpeg_scan():
    media = mpeg_audio.pack(b"x" * 192 * 9)
    found = mpeg_audio.scan(media)
    assert (found.vbr_frames, found.vbr_bytes, len(found.offsets), found.tags["TSIZ"]) == (3, found.offsets[-1] + found.sizes[-1] - found.offsets[0] + 960, 3, str(192 * 9))
    assert mpeg_audio.seek(found, 1152 * 2 + 5) == found.offsets[2] and mpeg_audio.seek(found, 1152 * 3) is None
    cut = media[: found.offsets[1]] + b"noise\xff\xfb\x90junk" + media[found.offsets[1] :]
    again = mpeg_audio.scan(cut)
    assert (again.resyncs, again.skipped, len(again.offsets)) == (1, 12, 3) and mpeg_audio.unpack(cut, again) == b"x" * 192 * 9
    bad = bytearray(media)
    bad[found.offsets[0] + 10] ^= 1
    assert mpeg_audio.scan(bytes(bad)).crc_bad == 1
    assert mpeg_audio.scan(b"").feature().startswith("no frames") and mpeg_audio.scan(b"\xff" * 50).offsets == []
    vbri = mpeg_audio.frame_head(4).ljust(36, b"\0") + b"VBRI" + bytes(6) + (7).to_bytes(4, "big") + (9).to_bytes(4, "big")
    assert mpeg_audio.scan(vbri.ljust(960, b"\0")).vbr == "VBRI"
    layer2 = bytes((0xFF, 0xFD, 0x84, 0xC0))
    assert mpeg_audio.header(layer2).size == 144 * 128 * 1000 // 48000 and mpeg_audio.header(b"\xff\xff\xff\xff") is None


def layer_two(bits: str, mode: int = 3, kbps_index: int = 8) -> bytes:
    """One frame of MPEG-1 Layer II at 48 kHz: head, checksum by plain long division over `bits`, and these bits."""
    head = bytes((0xFF, 0xFC, kbps_index << 4 | 1 << 2, mode << 6))
    crc = 0xFFFF
    for bit in "".join(f"{b:08b}" for b in head[2:]) + bits:
        top, crc = crc >> 15, crc << 1 & 0xFFFF
        crc ^= 0x8005 if top ^ int(bit) else 0
    body = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    return (head + crc.to_bytes(2, "big") + body).ljust(mpeg_audio.header(head).size, b"\0")


def test_checksums_of_all_layers():
    # Layer II, mono, 27 subbands: allocation of 88 bits, two bits more for each that has any
    allocation = "0001" + "0000" * 10 + "101" + "000" * 11 + "01" + "00" * 3
    frame = layer_two(allocation + "11" + "01" + "10")
    found = mpeg_audio.scan(frame * 3)
    assert (found.first.layer, found.crc_good, found.crc_bad, len(found.offsets)) == (2, 3, 0, 3)
    bad = bytearray(frame * 3)
    bad[6] ^= 0x10
    assert (mpeg_audio.scan(bytes(bad)).crc_good, mpeg_audio.scan(bytes(bad)).crc_bad) == (2, 1)
    # joint stereo of Layer I with bound 8: 4 bits for 2 x 8 + 24 subbands
    head = bytes((0xFF, 0xFE, 4 << 4 | 1 << 2, 1 << 6 | 1 << 4))
    h = mpeg_audio.header(head)
    assert (h.layer, h.bound, mpeg_audio.checked_bits(head, 0, h)) == (1, 8, 160)
    covered = bytes(range(20))
    one = (head + mpeg_audio.crc16(head[2:] + covered).to_bytes(2, "big") + covered).ljust(h.size, b"\1")
    assert mpeg_audio.scan(one * 2).crc_good == 2
    packed = mpeg_audio.pack(b"y" * 192 * 2)
    assert mpeg_audio.scan(packed).crc_good == 2  # the table's frame and one of audio


def test_delay_free_format_and_tags():
    first = bytearray(mpeg_audio.frame_head(4) + b"Xing" + (0).to_bytes(4, "big") + b"LAME3.100" + bytes(12) + (576 << 12 | 1000).to_bytes(3, "big")).ljust(960, b"\0")
    frame = mpeg_audio.frame_head(1).ljust(240, b"\0")
    found = mpeg_audio.scan(bytes(first) + frame * 4)
    assert (found.delay, found.padding, found.samples, found.duration) == (576, 1000, 4 * 1152, 4 * 1152 - 1576)
    free = bytes((0xFF, 0xFB, 0x04, 0xC0)).ljust(417, b"\7")
    found = mpeg_audio.scan(free * 5)
    assert found.offsets == [417 * k for k in range(5)] and found.sizes == [417] * 5 and found.samples == 5 * 1152
    old = b"ID3\2\0\0" + mpeg_audio.syncsafe(6 + 6) + b"TT2" + (6).to_bytes(3, "big") + b"\0title"
    extended = b"ID3\3\0\xc0" + mpeg_audio.syncsafe(4 + 6 + 10 + 6) + (6).to_bytes(4, "big") + bytes(6) + b"TPE1" + (5).to_bytes(4, "big") + bytes(2) + b"\0a\xff\0bc"
    footed = b"ID3\4\0\x10" + mpeg_audio.syncsafe(14) + b"TALB" + mpeg_audio.syncsafe(4) + bytes(2) + b"\3one" + b"3DI\4\0\x10" + mpeg_audio.syncsafe(14)
    item = (3).to_bytes(4, "little") + bytes(4) + b"Genre\0" + b"pop"
    ape = item + b"APETAGEX" + (2000).to_bytes(4, "little") + (len(item) + 32).to_bytes(4, "little") + (1).to_bytes(4, "little") + bytes(12)
    found = mpeg_audio.scan(old + extended + footed + frame * 2 + ape + b"TAG" + b"v1".ljust(125, b"\0"))
    assert found.tags == {"TT2": "title", "TPE1": "a\xffbc", "TALB": "one", "ape.genre": "pop", "v1.title": "v1"}
    assert (found.skipped, found.resyncs, len(found.offsets)) == (0, 0, 2)


# --- 2

def test_token_counts(spark, odd, none):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    count = token_count.TokenCounter(P.path("piece_bpe_32k.model"))
    many = fuzz() + TEXTS
    assert count.counts(many) == list(map(len, lib.encode(many)))
    assert len(count.single) > 10_000
    got = token_count.count_tokens(odd, P.path("piece_bpe_32k.model"), limit=5).collect()
    assert [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got] == [(i, len((t or "").encode()), (n := len(lib.encode(t or ""))), n > 5) for i, t in ODD]
    assert token_count.count_tokens(none, P.path("piece_bpe_32k.model")).collect() == []


def test_piece_cache():
    asked = []
    cache = PieceCache(lambda x: [asked.append(p) or len(p) for p in x], most=4)
    for lists in ([["a", "bb"], ["a"]], [["ccc", "a"]], [["dddd", "a"], []], [["bb"]]):
        assert cache.values(lists) == [list(map(len, x)) for x in lists]
    assert asked.count("a") == 1


# --- 3

def test_shards(spark, odd, none):
    path = P.path("word_bpe_49k.json")
    manifest = sstable.write_shards(spark, odd, path, work_path(spark, "t"), end_id=1, partitions=3)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in sstable.read_shards(spark, manifest).collect()), key=lambda r: r[1])
    assert got == brute.sstable_rows([(i, t or "") for i, t in ODD])
    rows = manifest.orderBy("part", "roll").collect()
    (found,) = sstable.lookup(rows, 2)
    assert found.tolist()[-1] == 1 and len(sstable.lookup(rows, 3)) == 2 and sstable.lookup(rows, 999) == [] and len(sstable.lookup(rows, None)) == 2
    empty = sstable.write_shards(spark, none, path, work_path(spark, "t"))
    assert sstable.read_shards(spark, empty).collect() == []


def test_shard_blocks(tmp_path):
    w = sstable.ShardWriter(2, 0)
    for k in range(0, 6000, 3):
        w.add(sstable.key_of(k), np.full(50, k, "<u2").tobytes())
    (tmp_path / "s").write_bytes(w.data())
    s = sstable.Shard(str(tmp_path / "s"))
    assert len(s.index) > 2 and all(s.get(k)[0].tolist() == [k] * 50 for k in range(0, 6000, 333)) and s.get(4) == []
    assert sum(s.may_hold(sstable.key_of(k)) for k in range(1, 6000, 3)) < 60
    assert [sstable.id_of(sstable.key_of(k)) for k in (None, -5, 7)] == [None, -5, 7]


def test_word_encoder():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    many = fuzz() + TEXTS
    assert sstable.WordEncoder(P.path("word_bpe_49k.json")).encode(many) == [np.array(e.ids, "<u2").tobytes() for e in lib.encode_batch(many, add_special_tokens=False)]


# --- 4

def test_url_rules(spark):
    rows = [(1, "https://a.example.net/en/x"), (2, "https://a.example.net/de/x"), (3, "HTTP://WWW.Example.COM/de/?q"), (4, "https://example.com"), (5, "https://b.org/fr/"), (6, None), (7, "no scheme"), (8, "https://cheap-pills.example.com/1"), (9, "https://notexample.com/de/"), (None, "https://x.net/"), (1, "https://a.example.net/en/x")]
    df = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, q.url_model()).collect()]
    assert got == [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "a.example.net", "/de/x", "net/", "block"), (3, "www.example.com", "/de/", "example.com/de/", "block"), (4, "example.com", "", None, "allow"), (5, "b.org", "/fr/", "org/fr/", "allow"),
        (6, "", "", None, got[5][4]), (7, "", "", None, got[5][4]), (8, "cheap-pills.example.com", "/1", None, "block"), (9, "notexample.com", "/de/", None, got[8][4]), (None, "x.net", "/", "net/", "block"), (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
    ]
    plan = url_filter.judge_urls(df, q.url_model())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert url_filter.judge_urls(df.limit(0), q.url_model()).collect() == []


def blocks(url: str) -> bool:
    bias, weights = q.url_model()
    host, _, path = url.partition("://")[2].partition("/")
    g = url_filter.grams(f"{host}/{path.partition('?')[0]}")
    return bias + sum(weights[b] for b in g) / len(g) ** 0.5 >= 0


def test_url_training():
    """Hosts that the fit has not seen, and the fit against plain arrays."""
    held, seen = url_filter.labelled_urls(True), url_filter.labelled_urls(False)
    assert len(held) > 100 and not {u.split("/")[2] for u, _ in held} & {u.split("/")[2] for u, _ in seen}
    assert np.mean([blocks(u) == bool(y) for u, y in held]) >= 0.9 and np.mean([blocks(u) == bool(y) for u, y in seen]) >= 0.98
    x, y = np.zeros((len(seen), url_filter.BUCKETS)), np.array([b for _, b in seen], float)
    for k, (u, _) in enumerate(seen):
        host, _, path = u.partition("://")[2].partition("/")
        g = url_filter.grams(f"{host}/{path.partition('?')[0]}")
        np.add.at(x[k], g, 1 / len(g) ** 0.5)
    w, b = np.zeros(url_filter.BUCKETS), 0.0
    used = x.any(axis=0)
    for _ in range(200):
        e = 1 / (1 + np.exp(-np.clip(b + x @ w, -30, 30))) - y
        w -= used * (10 / len(y) * (e @ x) + 1e-4 * w)
        b -= 0.5 / len(y) * e.sum()
    bias, weights = q.url_model()
    assert abs(bias / url_filter.SCALE - b) < 1e-5 and np.allclose(np.array(weights) / url_filter.SCALE, w, atol=1e-5)
    assert url_filter.train([]) == (0, [0] * url_filter.BUCKETS)
    with pytest.raises(ValueError):
        url_filter.train(seen, most_rows=3)


def test_empty_and_long_urls(spark):
    rows = [(1, ""), (2, "://"), (3, "https://" + "a" * 100_000 + ".example.com/de/x"), (4, "https://h.example.com/" + "p" * 50_000 + "?q#f")]
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), q.url_model()).collect()}
    assert (got[1]["host"], got[1]["path"], got[2]["host"], got[2]["rule"]) == ("", "", "", None)
    assert got[3]["rule"] == "example.com/de/" and got[3]["verdict"] == "block" and len(got[4]["path"]) == 50_001


# --- 5

def test_bpe(spark, odd, none):
    how = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    want = brute.tiktoken_encoding()
    own = bpe.ByteBpe(*how)
    for t in fuzz() + TEXTS:
        (ids,) = own.encode([t])
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(t) and own.decode(ids) == t.encode()
    got = bpe.decode_documents(bpe.encode_documents(odd, *how), *how).collect()
    assert [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in got] == [(i, want.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD]
    assert bpe.round_trip_documents(odd, *how).collect() == got
    assert bpe.decode_documents(bpe.encode_documents(none, *how), *how).collect() == bpe.round_trip_documents(none, *how).collect() == []


def test_rank_queue():
    queue, draw, held = bpe.RankQueue(50_000), random.Random(3), set()
    for _ in range(3000):
        r = draw.randrange(50_000)
        if r not in held:
            queue.put(r, [r])
            held.add(r)
        if draw.random() < 0.5:
            assert queue.first() == min(held) and queue.take(min(held)) == [min(held)]
            held.discard(min(held))
    while held:
        assert queue.first() == min(held)
        held.discard(queue.take(queue.first())[0])
    assert queue.first() == -1


def test_merge_order():
    """A later token of lesser rank goes first, wherever it comes from."""
    import os
    import tempfile

    with tempfile.TemporaryDirectory() as d:
        singles = [bytes([b]) for b in range(256)]
        more = [b"cd", b"abc", b"ab", b"bc", b"xab", b"aa", b"aaaa"]
        path = os.path.join(d, "r")
        with open(path, "wb") as f:
            f.write(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(singles + more)))
        import tiktoken

        lib = tiktoken.Encoding("x", pat_str=r"[\s\S]+", mergeable_ranks={t: i for i, t in enumerate(singles + more)}, special_tokens={})
        own = bpe.ByteBpe(path, r"[\s\S]+")
        draw = random.Random(1)
        for _ in range(3000):
            t = "".join(draw.choice("abcdx") for _ in range(draw.randrange(1, 14)))
            assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == lib.encode_ordinary(t), t


# --- 6

def test_quality(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_quality(spark, docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    right = [(r["predicted"], r["quality"]) for r in rows]
    assert len(right) > 50 and np.mean([a == b for a, b in right]) >= 0.95
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.3) == r["predicted"] for r in got.collect())
    held = {r["doc_id"] for r in got.where("held_out").collect()}
    assert held == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    empty = labels.limit(0)
    assert {(r["score"], r["predicted"]) for r in quality.score_quality(spark, odd, empty).collect()} == {(0.5, 1)}
    messy = spark.createDataFrame([(0, None), (0, 1), (1, 0), (1, 0), (2, 1), (None, 1)], "doc_id long, quality int")
    assert quality.score_quality(spark, odd, messy).count() == len(ODD)
    assert quality.score_quality(spark, none, labels).collect() == []


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in quality.score_quality(spark, docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_statistics_are_of_all_words():
    """Shares of words in a text whose pattern repeats: every fifth word is a number, every fifth in capitals."""
    got = dict(zip(quality.NAMES, quality.statistics("123 NASA some plain words " * 200)))
    assert got["bare_words"] == 0.2 and got["capitals"] == 0.2


def test_pooling():
    first, values = quality.pooled(np.array([0, 2, 1, 3.0]), np.array([2, 2, 2, 3.0]))
    assert first.tolist() == [0, 1, 3] and values.tolist() == [0, 0.75, 1]


def isotonic(n, y):
    """The isotonic means by their definition: at each place the largest over starts of the least mean over ends."""
    k = len(n)
    mean = lambda a, b: y[a : b + 1].sum() / n[a : b + 1].sum()
    return np.array([max(min(mean(a, b) for b in range(i, k)) for a in range(i + 1)) for i in range(k)])


def test_curve():
    draw = np.random.default_rng(4)
    for _ in range(50):
        n = draw.integers(1, 9, 30).astype(float)
        y = np.floor(draw.uniform(0, 1, 30) * (n + 1)).clip(0, n)
        first, values = quality.pooled(y, n)
        assert np.allclose(np.repeat(values, np.diff([*first, 30])), isotonic(n, y))
        knots, heights = quality.curve(np.arange(30.0), n, y)
        assert (np.diff(knots) > 0).all() and (np.diff(heights) > 0).all()


def test_fit_by_plain_arrays(spark):
    """The weights and the curve, from sums over partitions, against numpy on all rows at once."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(spark, quality.vectors(docs), labels)
    known = {r["doc_id"]: float(r["quality"]) for r in labels.collect() if r["quality"] is not None}
    rows = [(i, quality.statistics(r["text"] or ""), known[i]) for r in docs.collect() if (i := r["doc_id"]) in known and zlib.crc32(str(i).encode()) % 5]
    learn, test = ([r for r in rows if (zlib.crc32(str(r[0]).encode()) % 5 == 1) == c] for c in (False, True))
    x, y = np.array([s for _, s, _ in learn]), np.array([q for _, _, q in learn])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-3))
    f = model.features(x)
    ridge = np.diag([quality.RIDGE * len(x)] * quality.FEATURES + [1e-9])
    assert np.allclose(model.weight, np.linalg.solve(f.T @ f + ridge, f.T @ y), atol=1e-6)
    gap = np.abs(model.features(x[:50]) @ model.features(x[:50]).T - 1 - np.exp(-((np.clip((x[:50, None] - x[None, :50]) / model.scale, -8, 8) ** 2).sum(axis=2)) / 2 / quality.WIDTH**2))
    assert np.median(gap) < 0.1  # the features' products are near the kernel
    at = np.clip(((model.raw(np.array([s for _, s, _ in test])) + 0.5) / 2 * quality.BINS).astype(int), 0, quality.BINS - 1)
    n, hits = np.bincount(at, minlength=quality.BINS), np.bincount(at, weights=[q for _, _, q in test], minlength=quality.BINS)
    used = np.flatnonzero(n)
    means = isotonic(n[used].astype(float), hits[used])
    middle = (used + 0.5) / quality.BINS * 2 - 0.5
    steps = [(np.average(middle[means == v], weights=n[used][means == v]), v) for v in np.unique(means)]
    assert np.allclose(model.knots, [k for k, _ in steps]) and np.allclose(model.values, [v for _, v in steps])


def test_scores_rank(spark):
    got = [r["score"] for r in q.op6_quality(spark, "/root/testdata/sf0.01").collect()]
    assert len(set(got)) > 0.5 * len(got)


# --- 7

def test_archives(spark):
    rows = [(1, "https://b.org/x", "same"), (2, "https://a.org/y?q#f", "same"), (3, "https://www.a.org/", "other"), (4, None, None), (5, "", ""), (6, "https://a.org/y", "same"), (6, "https://a.org/y", "same"), (None, "https://c.org/", "same"), (None, "x", "alone"), (8, "https://z.org/" + "p" * 3000, "é" * 200_000)]
    pages = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, digest string, offset int")
    directory = capture_index.write_archives(spark, pages, work_path(spark, "t"))
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in capture_index.read_archives(spark, directory, pages).collect()), key=str)
    most = {}
    for i, _, h in rows:
        most[h or ""] = max(most.get(h or "", -1), -1 if i is None else i)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    want = [(i, len((h or "").encode()), digest(h), *(("response", None) if most[h or ""] in (i, -1) else ("revisit", most[h or ""]))) for i, _, h in rows]
    assert got == sorted(want, key=str)
    index = capture_index.CaptureIndex(directory)
    assert [(r["page_id"], r["payload"]) for r in index.find("https://www.a.org/")] == [(3, b"other")]
    assert len(index.find("https://a.org/y")) == 2 and index.find("https://nowhere.org/") == []
    assert capture_index.sort_key("https://User@WWW.A.org:8080/x?y#z") == "org,a,www:8080)/x?y"
    nothing = capture_index.write_archives(spark, pages.limit(0), work_path(spark, "t"))
    assert capture_index.read_archives(spark, nothing, pages).collect() == []
    large = capture_index.read_archives(spark, capture_index.write_archives(spark, pages, work_path(spark, "t"), least_bytes=5), pages).where("record_type = 'revisit'")
    assert large.collect() == []


# --- 8

def test_leaks(spark, odd, none):
    docs, bench = texts(spark), texts(spark, "benchmark", "item_id")
    got = {(r["doc_id"], r["item_id"]) for r in q.op8_decontamination(spark, FOLDER).collect()}
    squeezed = lambda t: decontamination.plain(t).replace("\n", " ")
    assert got >= {(i, b) for i, t in docs.items() for b, x in bench.items() if squeezed(x) in squeezed(t)}
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontamination.find_leaks(spark, odd, items).collect() == [] == decontamination.find_leaks(spark, none, items).collect()
    assert decontamination.find_leaks(spark, odd, items.limit(0)).collect() == []
    odd_items = spark.createDataFrame([(1, "a"), (2, None), (None, "Hello  world"), (1, "a"), (3, "")], "item_id long, text string")
    found = decontamination.find_leaks(spark, odd, odd_items).where("doc_id = 3").collect()
    assert sorted((r["item_id"], r["start"], r["end"], r["edits"]) for r in found if r["item_id"] is None) == [(None, 0, 12, 0)] * 2


def test_leaks_are_all_within_budget():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(draw.randrange(1, 4)))
    bench = {k: " ".join(word() for _ in range(draw.randrange(6, 25))) for k in range(12)}
    items = decontamination.Items(tuple((i, t, 1) for i, t in bench.items()))
    for _ in range(120):
        b = draw.choice(list(bench))
        x, m = list(bench[b]), len(bench[b])
        for _ in range(draw.randrange(0, decontamination.budget(m) + 6)):
            p = draw.randrange(len(x))
            draw.choice([lambda: x.__setitem__(p, "q"), lambda: x.__delitem__(p), lambda: x.insert(p, "z")])()
        doc = " ".join(word() for _ in range(40)) + "".join(x) + " ".join(word() for _ in range(40))
        got = {}
        for i, _, _, d, _ in items.matches(doc):
            got[i] = min(d, got.get(i, d))
        want = {i: d for i, t in bench.items() if (d := brute.substring_distance(t, doc)) <= decontamination.budget(len(t))}
        assert got == want and items.found_in(doc) == bool(want)


def test_all_places_of_an_item():
    """Every place that holds an item, by brute force over all starts: of overlapping ones that with the fewest edits, then the first."""
    draw = random.Random(10)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 7)))
    for _ in range(25):
        item = " ".join(word() for _ in range(6))
        m, e = len(item), decontamination.budget(len(item))
        parts = [" ".join(word() for _ in range(8))]
        for _ in range(4):
            x = list(item)
            for _ in range(draw.randrange(0, e + 1)):
                x[draw.randrange(len(x))] = "Q".lower()
            parts += ["".join(x), " ".join(word() for _ in range(draw.randrange(0, 6)))]
        doc = " ".join(parts)
        got = decontamination.Items(((5, item, 2),)).matches(doc)
        assert got[::2] == got[1::2]
        places = [(a, b) for _, a, b, _, _ in got[::2]]
        assert len(places) >= 4 and all(b <= c for (_, b), (c, _) in zip(places, places[1:]))
        for _, a, b, d, _ in got:
            assert brute.edit_distance(list(item), list(doc[a:b])) == d <= e
        # whatever lies between the places found holds the item nowhere
        for (_, a), (b, _) in zip([(0, 0), *places], [*places, (len(doc), 0)]):
            assert brute.substring_distance(item, doc[a:b]) > e


def test_blocks_of_the_benchmark(spark, monkeypatch):
    """Several blocks give what one gives."""
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(tuple, decontamination.find_leaks(spark, docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 4000)
    assert len(decontamination.index_files(spark, items)) > 3
    assert sorted(map(tuple, decontamination.find_leaks(spark, docs, items).collect())) == one and one


def test_leaks_in_repeated_text():
    items = decontamination.Items(((1, "the the the quick thing and another thing of the kind", 1),))
    assert items.matches("the " * 4000) == [] and items.matches("so " + "the " * 500 + "the quick thing and another thing of the kind")[0][3] == 0


# --- 9

def test_secrets(spark, odd, none):
    draw = random.Random(2)
    parts = ["token", "=", "secret", ":", " ", "'", "AKIA", "A" * 18, "api_key", "API", "key", "ab0" * 9, "x", "\n", "password", "İ", '"', "passwd"]
    for t in ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 20))) for _ in range(3000)] + TEXTS + list(texts(spark).values()):
        assert [s for s in secret_scan.find(t) if s[0] in secret_scan.BASE] == brute.secrets(t)
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = "ghp_" + body + secret_scan.base62(zlib.crc32(body.encode()))
    assert [s[0] for s in secret_scan.find(f"x {good} y")] == ["github"] and secret_scan.find(f"x {good[:-1]}_ y") == [] and secret_scan.find("ghp_" + "g" * 36) == []
    jwt = "eyJ" + base64.urlsafe_b64encode(b'{"alg":"HS256"}').decode()[3:].rstrip("=") + ".abc.def"
    assert [s[0] for s in secret_scan.find(jwt)] == ["jwt"]
    import time

    for t in ("eyJ" * 350_000, "eyJ" * 100_000 + ".abc.def", "eyJhIjp7" * 100_000 + ".abc.def"):
        began = time.perf_counter()
        assert secret_scan.find(t) == [] and time.perf_counter() - began < 5
    assert [s[0] for s in secret_scan.find("card: 4111 1111 1111 1111")] == ["card"] and secret_scan.find("card: 4111 1111 1111 1112") == []
    assert secret_scan.redact("a token=abcdef b", secret_scan.find("a token=abcdef b")) == "a [assign] b"
    got = secret_scan.scan_secrets(odd).collect()
    assert [(r["doc_id"], r["secrets"]) for r in got] == [(i, []) for i, _ in ODD] and secret_scan.scan_secrets(none).collect() == []


# --- 10

def corpus(n=60):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(400)]
    text = lambda k: [draw.choice(vocabulary) for _ in range(k)]
    shared, out = text(70), []
    for k in range(n):
        base = text(draw.randrange(20, 120))
        out.append(base)
        if k % 3 == 0:
            near = [w if draw.random() > 0.04 else "edit" for w in base]
            out += [near, base]
        if k % 4 == 0:
            out.append(shared + text(24))
    return {i: " ".join(w) + "." for i, w in enumerate(out)}


def test_near_duplicates(spark, odd, none):
    docs = corpus()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark, df).collect()}
    want = brute.classes(docs)
    assert got == want and len(set(want.values())) < len(docs)
    rows = order_minhash.near_duplicates(spark, odd).collect()
    assert len(rows) == len(ODD) and all(r["class_id"] == 3 for r in rows if r["doc_id"] == 3)
    assert order_minhash.near_duplicates(spark, none).collect() == []


def test_classes_that_hubs_leave_apart(spark):
    """A chain of documents around a passage that all share: the hub is like none of them, neighbours are alike."""
    draw = random.Random(4)
    word = lambda k: [f"w{draw.randrange(10**6)}" for _ in range(k)]
    shared = word(70)
    hub, docs, own = shared + word(28), {}, word(28)
    docs[0] = hub
    for k in range(1, 30):
        own = own[:25] + word(3) if k % 2 else own
        docs[k] = shared + own
    for k in range(30, 60):
        docs[k] = shared + word(28)
    texts = {k: " ".join(w) for k, w in docs.items()}
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute.classes(texts)


def test_pairs_of_one_bucket(spark):
    """Pairs around a passage that all share: none is like the hub, and the two of a pair share few sketches. Small buckets and one of very many nodes."""
    draw = random.Random(6)
    word = lambda k: [f"w{draw.randrange(10**6)}" for _ in range(k)]
    for pairs in (20, 60):
        shared, docs = word(70), []
        docs.append(shared + word(28))
        for _ in range(pairs):
            own = word(30)
            docs += [shared + own, [w if k % 10 else "edit" for k, w in enumerate(shared)] + own[:20] + word(10)]
        texts = {k: " ".join(w) for k, w in enumerate(docs)}
        keys = {k: set(order_minhash.bucket_keys(order_minhash.word_codes(t))) for k, t in texts.items()}
        links = {(a, b) for a in texts for b in texts if a < b and keys[a] & keys[b]}
        want = [(a, b) for a, b in links if brute.edit_distance(docs[a], docs[b]) <= 0.2 * max(len(docs[a]), len(docs[b])) + 1e-9]
        got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
        assert len(want) > pairs / 2 and all(got[a] == got[b] for a, b in want)
        assert len(set(got.values())) > 2


def test_short_texts_meet():
    """Nearly all similar pairs of short texts share a sketch, wherever their edits are."""
    draw, met = random.Random(8), []
    for _ in range(4000):
        a = [draw.randrange(4000) for _ in range(draw.randrange(4, order_minhash.SHORT + 1))]
        b = list(a)
        for _ in range(draw.randrange(0, len(a) // 5 + 1)):
            at = draw.randrange(len(b) + 1)
            b[at : at + draw.randrange(2)] = [draw.randrange(4000)] * draw.randrange(2)
        if a != b and max(len(a), len(b)) <= order_minhash.SHORT and brute.edit_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
            met.append(bool(set(order_minhash.bucket_keys(np.array(a, np.uint32))) & set(order_minhash.bucket_keys(np.array(b, np.uint32)))))
    assert len(met) > 1000 and np.mean(met) >= 0.998


def test_prefix_keys_lose_no_pair():
    """Texts that are alike share a key at every step, whatever order of runs the filter takes."""
    draw, rng, tried = random.Random(9), np.random.default_rng(9), 0
    rarities = [rng.integers(2, most, 1 << order_minhash.RARITY_BITS).astype(np.int32) for most in (5, 10**6, 3, 1000)]
    for trial in range(600):
        a = [draw.randrange(30 if trial % 3 else 10**6) for _ in range(draw.randrange(1, 80))]
        b = list(a)
        for _ in range(int(0.2 * len(a))):
            at = draw.randrange(len(b) + 1)
            b[at : at + draw.randrange(2)] = [draw.randrange(10**6)] * draw.randrange(2)
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        if order_minhash.similar([(x, y)])[0] is None or a == b:
            continue
        tried += 1
        for size in (2, 1):
            parents = other = [(0, -1)]
            for shared in range(1, min(4, order_minhash.shared_words(x, y)) + 1 if size == 1 else 2):
                found = [dict(zip(*order_minhash.prefix_keys(t, rarities[trial % 4], p, size, shared))) for t, p in ((x, parents), (y, other))]
                both = found[0].keys() & found[1].keys()
                assert both, (a, b, size, shared)
                parents, other = ([(k, f[k]) for k in sorted(both)] for f in found)
    assert tried > 200


def test_marked_nodes(spark):
    """Every node that is marked passes; hardly any other does."""
    nodes = spark.range(0, 50_000).selectExpr("id * 7919 + (1L << 35) * (id % 5) AS node")
    marked = order_minhash.marked_nodes(nodes.where("node % 10 = 0"))
    got = nodes.where(marked(F.col("node"))).select(F.count("*").alias("n"), F.count_if(F.expr("node % 10 = 0")).alias("own")).first()
    assert got["own"] == nodes.where("node % 10 = 0").count() and got["n"] < 1.01 * got["own"] + 50
    assert nodes.where(order_minhash.marked_nodes(nodes.limit(0))(F.col("node"))).count() == 0


@pytest.mark.parametrize("longs, shorts, mixed_up", [(30, 100, False), (200, 200, False), (300, 100, True)])
def test_links_through_a_common_passage(spark, longs, shorts, mixed_up):
    """Long texts with a passage and many words of their own come first and are unlike all; short ones with the passage are one class."""
    draw = random.Random(longs)
    word = lambda n: [f"w{draw.randrange(10**7)}" for _ in range(n)]
    passage = word(90)
    rows = [(k, " ".join(passage + word(60))) for k in range(longs)] + [(1000 + k, " ".join(passage + word(20))) for k in range(shorts)]
    if mixed_up:
        draw.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[k] for k in range(longs)} == set(range(longs)) and {got[1000 + k] for k in range(shorts)} == {1000}


def test_groups_around_passages(spark):
    """Passages of 30 to 90 % of a text, quoted by texts of other lengths; copies with edits: the classes of all pairs."""
    draw, rows = random.Random(12), []
    word = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    for share in (0.3, 0.5, 0.7, 0.8, 0.9):
        passage = word(60)
        for _ in range(40):
            own = word(int(60 / share) - 60 + draw.randrange(4))
            at = draw.randrange(len(own) + 1)
            text = own[:at] + passage + own[at:]
            rows.append(text)
            if draw.random() < 0.4:
                copy = list(text)
                for _ in range(draw.randrange(int(0.22 * len(copy)))):
                    copy[draw.randrange(len(copy))] = word(1)[0]
                rows.append(copy)
    codes = [order_minhash.word_codes(" ".join(r)) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)]
    close = [p for p, s in zip(pairs, order_minhash.similar([(codes[i], codes[j]) for i, j in pairs])) if s is not None]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in close:
        a, b = find(i), find(j)
        top[max(a, b)] = min(a, b)
    order = list(range(len(rows)))
    draw.shuffle(order)
    df = spark.createDataFrame([(i, " ".join(rows[i])) for i in order], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark, df).collect()}
    together = [(i, j) for i, j in close if got[i] == got[j]]
    assert len(close) > 500 and len(together) >= 0.99 * len(close)
    assert all(find(i) == find(c) for i, c in got.items())


def test_ids_that_name_several_texts(spark):
    """Rows of one id with different texts are different nodes; near copies without id join the class of those with one."""
    import corpus_pipeline

    draw = random.Random(11)
    text = lambda n=60: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    near = lambda x, at=7: [*x[:at], "edit", *x[at + 1 :]]
    a, b, c, x, y = text(), text(), text(), text(), text()
    rows = [(1, a, "p"), (1, b, "p"), (2, near(b), "p"), (3, c, "p"), (5, x, "p"), (None, near(x), "p"), (None, y, "q"), (None, near(y), "p"), (-4, near(c), "p"), (None, near(c, 9), "p"), (9, text(), "p"), (9, None, "p"), (3, c, "o")]
    df = spark.createDataFrame([(i, None if t is None else " ".join(t), s) for i, t, s in rows], "doc_id long, text string, source string")
    got, by = order_minhash.near_duplicates(spark, df).collect(), {}
    for r in got:
        by.setdefault(r["class_key"], []).append((r["doc_id"], r["class_id"]))
    ids = sorted((sorted(str(i) for i, _ in v), {k for _, k in v}) for v in by.values())
    assert [m for m, _ in ids if m != ["None", "None"]] == [["-4", "3", "3", "None"], ["1"], ["1", "2"], ["5", "None"], ["9"], ["9"]]
    assert all(len(k) == 1 for _, k in ids) and {next(iter(k)) for m, k in ids if m == ["1", "2"]} == {1} and {next(iter(k)) for m, k in ids if m == ["-4", "3", "3", "None"]} == {-4}
    assert len(got) == len(rows)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.single(spark, df, FOLDER).collect()]
    least = min((near(y), y), key=lambda t: order_minhash.words_digest(" ".join(t)))
    want = [(1, a), (1, b), (5, x), (-4, near(c)), (None, least), (9, rows[10][1])]
    assert sorted(kept, key=str) == sorted([(i, " ".join(t)) for i, t in want] + [(9, None)], key=str)


def test_short_and_scattered_edits(spark):
    """Texts with one changed word in the middle, and longer ones with evenly spread edits up to a similarity of 0.8."""
    draw = random.Random(7)
    docs = []
    for n, edits in [(n, max(1, n // 5)) for n in (5, 8, 10, 11, 12, 20, 25)] * 3 + [(30, 6), (60, 12), (100, 10), (100, 15), (100, 20), (300, 60)] * 4:
        a = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        b = list(a)
        for k in range(edits):
            b[(2 * k + 1) * n // (2 * edits)] = f"edit{draw.randrange(10**6)}"
        docs += [a, b]
    rows = [(k, " ".join(w)) for k, w in enumerate(docs)]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k // 2 * 2 for k in got}


def test_alignment():
    draw = np.random.default_rng(1)
    pairs = []
    for _ in range(200):
        a = draw.integers(0, 6, draw.integers(0, 60)).astype(np.uint32)
        b = np.delete(a, draw.integers(0, max(1, len(a)), 2)) if len(a) > 4 and draw.random() < 0.5 else draw.integers(0, 6, draw.integers(0, 60)).astype(np.uint32)
        pairs.append((a, b))
    assert order_minhash.aligned(pairs, 60).tolist() == [brute.edit_distance(a, b) for a, b in pairs]
    for (a, b), s in zip(pairs, order_minhash.similar(pairs, 0.8)):
        longest = max(len(a), len(b))
        assert (s is not None) == (brute.edit_distance(a, b) <= 0.2 * longest + 1e-9)


def test_sketch_order():
    a = np.arange(300, dtype=np.uint32)
    same = sum(x == y for x, y in zip(order_minhash.sketch(a), order_minhash.sketch(np.concatenate([a[150:], a[:150]]))))
    assert order_minhash.sketch(a) == order_minhash.sketch(a.copy()) and same < order_minhash.SLOTS / 2 and order_minhash.sketch(a[:4]) == []
    repeated = order_minhash.labelled(np.ones(50, np.uint32))
    assert len(np.unique(repeated)) == 46
    long = np.arange(9000, dtype=np.uint32)
    values = order_minhash.labelled(long)
    assert len(order_minhash.sketch(long)) == order_minhash.SLOTS and len(values) == 8996


# --- pipeline and registry

def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    scored = {r["doc_id"]: r["predicted"] for r in q.op6_quality(spark, FOLDER).collect()}
    kept = {i: t for i, t in rows.items() if scored[i]}
    found = order_minhash.near_duplicates(spark, docs.where(F.col("doc_id").isin(*kept)))
    kept = {r["doc_id"]: kept[r["doc_id"]] for r in found.where("doc_id = class_id").collect()}
    bench = [decontamination.plain(t).replace("\n", " ") for t in texts(spark, "benchmark", "item_id").values()]
    kept = {i: t for i, t in kept.items() if not any(b in decontamination.plain(t).replace("\n", " ") for b in bench)}
    kept = {i: secret_scan.redact(t, secret_scan.find(t)) for i, t in kept.items()}
    encoding = brute.tiktoken_encoding()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == {i: brute.bpe_row(encoding, t) for i, t in kept.items()} and 0 < len(got) < len(rows)


def test_stages_keep_columns(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta password=abcdef1", "en", "s", 5, "x"), (1, "alpha beta gamma delta epsilon zeta password=abcdef1", "en", "s", 5, "x"), (None, None, None, None, None, None), (2, "", "en", "s", 0, "y")], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, FOLDER)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.collect()
    (clean,) = {r["text"] for r in corpus_pipeline.without_secrets(spark, docs, FOLDER).where("doc_id = 1").collect()}
    assert clean == "alpha beta gamma delta epsilon zeta [assign]"
    assert corpus_pipeline.single(spark, docs, FOLDER).where("doc_id = 1").count() == 1


def test_stages_on_odd_rows(spark):
    """Columns named like helpers, very long texts, ties and rows without id, stage by stage."""
    import corpus_pipeline

    word = "password=abcdef1 and then some plain words of no use. "
    rows = [(k, word * n, "c", "x", "n", 1.5, len(word) * n) for k, n in ((1, 1), (2, 1), (3, 4000), (None, 2))] + [(5, None, "c", None, "n", None, None), (5, "", None, "x", None, 0.5, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, clean string, changed string, __row string, score double, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.dtypes == docs.dtypes
        got = [tuple(r) for r in out.collect()]
        assert {(r[0], r[2], r[3], r[4], r[5]) for r in got} <= {(r[0], r[2], r[3], r[4], r[5]) for r in rows}
    clean = {r["doc_id"]: r for r in corpus_pipeline.without_secrets(spark, docs, FOLDER).where("doc_id < 4").collect()}
    assert clean[3]["text"] == word.replace("password=abcdef1", "[assign]") * 4000 and clean[3]["n_chars"] == len(clean[3]["text"]) and clean[1]["clean"] == "c"
    kept = sorted(str(r["doc_id"]) for r in corpus_pipeline.single(spark, docs, FOLDER).collect())
    assert kept == ["1", "3", "5", "None"]


def test_registry():
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(k.startswith(n) for k in entry.queries()) == 1 for n in names) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_url_filter_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    assert sorted(map(tuple, q.op4_url_filter(spark, FOLDER).collect())) == sorted(con.execute(q.oracle_sql()["op4_url_filter"]).fetchall())


def test_components(spark):
    draw = random.Random(12)
    links = [(k, k + 1) for k in range(10_000, 11_000)] + [(500, k) for k in range(600, 640)] + [(draw.randrange(1000, 1060), draw.randrange(1000, 1060)) for _ in range(40)] + [(7, 7)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        if a != b:
            p, q = find(a), find(b)
            top[max(p, q)] = min(p, q)
    got = {r["node"]: r["label"] for r in order_minhash.components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(top)}
    assert order_minhash.components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


# --- the registered queries as their contracts state them

def test_contract_1(spark):
    got = {r["doc_id"]: r for r in q.op1_mpeg_audio(spark, FOLDER).collect()}
    docs = texts(spark)
    assert len(got) == len(docs)
    for i, t in docs.items():
        raw, r = t.encode(), got[i]
        payload = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        media = mpeg_audio.pack(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r["media_bytes"], r["media_sha256"], r["crc_bad"], r["crc_good"]) == (len(media), hashlib.sha256(media).hexdigest(), 0, r["frames"] + 1)
        assert r["duration_samples"] == 1152 * r["frames"] == 1152 * -(-len(payload) // 768) and [media[x : x + 2] for x in r["seek_offsets"]] == [b"\xff\xfa"] * r["frames"]


def test_contract_3(spark):
    got = sorted(map(tuple, q.op3_sstable(spark, FOLDER).collect()), key=lambda r: r[1])
    assert got == brute.sstable_rows(list(texts(spark).items()))


def test_contract_2_and_5(spark):
    import sentencepiece

    lib, encoding, docs = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")), brute.tiktoken_encoding(), texts(spark)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in q.op2_token_counts(spark, FOLDER).collect()}
    assert got == {i: (len(t.encode()), (n := len(lib.encode(t))), n > 4096) for i, t in docs.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in q.op5_byte_bpe(spark, FOLDER).collect()}
    assert got == {i: brute.bpe_row(encoding, t) for i, t in docs.items()}


def test_contract_7(spark):
    pages, most = texts(spark, "pages", "page_id", "html"), {}
    for i, h in pages.items():
        most[h] = max(i, most.get(h, i))
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in q.op7_warc(spark, FOLDER).collect()}
    digest = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    assert got == {i: (len(h.encode()), digest(h), *(("response", None) if most[h] == i else ("revisit", most[h]))) for i, h in pages.items()}


def test_contract_9(spark):
    got = {r["doc_id"]: r for r in q.op9_secret_scan(spark, FOLDER).collect()}
    docs = texts(spark)
    assert len(got) == len(docs)
    for i, t in docs.items():
        base = brute.secrets(t)
        of = lambda k: sum(s[0] == k for s in base)
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"], got[i]["base_sha256"]) == (of("assign"), of("access"), of("hex"), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest())
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(got[i]["spans"].split(","))


def test_contract_10(spark):
    """Links of sf0.01 against all pairs of near lengths: at least 99 of 100 are within one class, and no class joins what no links join."""
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = {r["doc_id"]: r["class_id"] for r in q.op10_order_minhash(spark, "/root/testdata/sf0.01").collect()}
    assert got.keys() == docs.keys()
    codes = {i: order_minhash.word_codes(t) for i, t in docs.items()}
    by_length = sorted(codes, key=lambda i: len(codes[i]))
    pairs = []
    for k, a in enumerate(by_length):
        for b in by_length[k + 1 :]:
            if len(codes[a]) < 0.8 * len(codes[b]):
                break
            if len(codes[b]) - order_minhash.shared_words(codes[a], codes[b]) <= 0.2 * len(codes[b]) + 1e-9:
                pairs.append((a, b))
    links = [p for p, s in zip(pairs, order_minhash.similar([(codes[a], codes[b]) for a, b in pairs])) if s is not None]
    assert len(links) > 100 and sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links)
    top = {i: i for i in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        p, r = find(a), find(b)
        top[max(p, r)] = min(p, r)
    assert all(find(i) == find(c) for i, c in got.items())


def test_many_rows_of_one_id(spark):
    """Rows of one id whose texts begin alike, read in many partitions and ranged into several: the order doesn't depend on either."""
    path, draw = P.path("word_bpe_49k.json"), random.Random(6)
    rows = [(5, "the same twenty-four characters " + " ".join(draw.choice(["a", "b", "cd"]) for _ in range(8))) for _ in range(400)]
    rows += [(None, "x" * 24 + str(k % 7)) for k in range(60)] + [(9, None), (4, "four")]
    want = brute.sstable_rows([(i, t or "") for i, t in rows])
    for parts in (7, 2):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        manifest = sstable.write_shards(spark, df, path, work_path(spark, "t"), end_id=1, partitions=4)
        got = sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in sstable.read_shards(spark, manifest).collect()), key=lambda r: r[1])
        assert got == want and manifest.count() > 1


def test_long_urls_take_time_by_their_length(spark):
    import time

    url = "https://" + "".join(random.Random(2).choice("abcdefgh.é😀") for _ in range(200_000)) + ".example.com/de/" + "p" * 800_000
    df = spark.createDataFrame([(1, url), (2, "https://a.example.com/é😀x")], "page_id long, url string")
    url_filter.judge_urls(df.where("page_id = 2"), q.url_model()).collect()
    began = time.time()
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, q.url_model()).collect()}
    assert time.time() - began < 20
    bias, weights = q.url_model()
    for i, u in ((1, url), (2, "https://a.example.com/é😀x")):
        host, _, path = u.partition("://")[2].partition("/")
        g = url_filter.grams(f"{host}/{path}")
        assert abs(got[i]["score"] - 1 / (1 + np.exp(-(bias + sum(weights[b] for b in g) / len(g) ** 0.5) / url_filter.SCALE))) < 1e-5


def test_pairs_in_shares(spark):
    """What the pairs of a step move at a time is bounded, however many they are, and no link is lost by it."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 5000, (6, 300)).astype(np.uint32)
    codes = [np.where(rng.random(300) < rng.choice([0.05, 0.15, 0.3]), rng.integers(0, 5000, 300), base[i % 6]).astype("<u4") for i in range(60)]
    met = spark.createDataFrame([(i, order_minhash.bag(c), c.tobytes()) for i, c in enumerate(codes)], "node long, bag binary, words binary").cache()
    names = [(i, j) for i in range(60) for j in range(i)]
    pairs = spark.createDataFrame(names, "a long, b long").cache()
    parts = [{tuple(r) for r in p.collect()} for p in order_minhash.shares(pairs, 1200 * len(names), 1200 * len(names) // 6)]
    assert len(parts) == 6 and sum(map(len, parts)) == len(names) and set().union(*parts) == set(names) and max(map(len, parts)) < len(names) / 2
    wanted = {p for p, s in zip(names, order_minhash.similar([(codes[i], codes[j]) for i, j in names])) if s is not None}
    got = order_minhash.verified(spark, pairs, met, 100_000)
    assert {tuple(r) for r in got.collect()} == wanted and 0 < len(wanted) < len(names)
    folders = {f.rpartition("/")[0] for f in got.inputFiles()}
    assert len(folders) > 1  # written in shares


def test_runs_of_several_classes(spark):
    """Runs are counted exactly, whatever their number and the groups they are dealt to; those of one class alone are left out, and texts that share too few get no entry."""
    rng, size = np.random.default_rng(3), order_minhash.GROUP_RUNS
    passage, word = rng.integers(0, 10**9, 90), lambda n: rng.integers(0, 10**9, n)
    texts = [np.concatenate([passage, word(60)]) for _ in range(20)] + [np.concatenate([passage[:20], word(200)]) for _ in range(20)] + [word(50)] * 2 + [passage[[0, 1, 2, 3]], passage[[0, 1, 9, 2, 3]]]
    texts = [t.astype("<u4") for t in texts]
    labels = [*range(40), 40, 40, 42, 43]
    met = spark.createDataFrame([(i, t.tobytes()) for i, t in enumerate(texts)], "node long, words binary")
    crowd = spark.createDataFrame([(i, len(t), x) for i, (t, x) in enumerate(zip(texts, labels))], "node long, n int, label long")
    wanted = {}
    for i, t in enumerate(texts):
        for r in order_minhash.runs_of(t).view(np.int64).tolist():
            wanted.setdefault(r, []).append(i)
    wanted = {(i, r, len(x)) for r, x in wanted.items() for i in x if len({labels[i] for i in x}) > 1}
    for total in (sum(map(len, texts)), 40 * size):
        assert {tuple(r) for r in order_minhash.shared_runs(crowd.join(met, "node"), total).collect()} == wanted
    got = order_minhash.by_runs(spark, met, crowd).collect()
    keys = {}
    for r in got:
        keys.setdefault(r["node"], set()).add(r["key"])
    assert set(keys) == {*range(20), 42, 43}  # 200 words of one's own leave too few; copies of one class share nothing with others
    assert all(keys[i] & keys[j] for i in range(20) for j in range(i)) and keys[42] & keys[43] and max(map(len, keys.values())) == 88 - 58 + 1


def test_runs_lose_no_pair():
    """Texts that are alike share as many runs as by_runs asks for, brief ones a run of some kind."""
    draw, tried = random.Random(5), 0
    for _ in range(3000):
        a = [draw.randrange(10**6) for _ in range(draw.randrange(3, 60) if draw.random() < 0.5 else draw.randrange(3, 12))]
        b = list(a)
        for _ in range(draw.randrange(int(0.25 * len(a)) + 1)):
            at = draw.randrange(len(b) + 1)
            b[at : at + draw.randrange(2)] = [draw.randrange(10**6)] * draw.randrange(2)
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        if a != b and order_minhash.similar([(x, y)])[0] is not None:
            tried += 1
            shared = len(set(order_minhash.runs_of(x).tolist()) & set(order_minhash.runs_of(y).tolist()))
            assert shared >= max(1 if n <= order_minhash.BRIEF else max(1, np.ceil(0.4 * n - 2 - 1e-9)) for n in (len(a), len(b))), (a, b)
    assert tried > 500


def test_worker_keeps_caches_of_one_operator(spark):
    """A worker that goes on to another operator no longer holds what the last one has cached."""
    from millrace.llm import _common

    order_minhash.CODES["some"] = 1
    _common.keep_caches_of(order_minhash.__name__)
    assert order_minhash.CODES
    _common.keep_caches_of(bpe.__name__)
    assert not order_minhash.CODES


def test_runs_come_back_packed(spark):
    """What the groups give back is at most the rows that they get, not a row for each run of each text."""
    rng = np.random.default_rng(7)
    passage = rng.integers(0, 10**9, 300)
    rows = [(i, np.concatenate([passage, rng.integers(0, 10**9, 40)]).astype("<u4").tobytes()) for i in range(60)]
    words = spark.createDataFrame([(i, 340, i, w) for i, w in rows], "node long, n int, label long, words binary").coalesce(2)
    packed = order_minhash.packed_runs(words, 4 * order_minhash.GROUP_RUNS)
    assert packed.count() <= 2 * 4 and order_minhash.shared_runs(words, 4 * order_minhash.GROUP_RUNS).count() == 60 * 298


def test_links_in_blocks(spark):
    """All links of a crowd between classes, by blocks, are those of all pairs; lengths at the limit and a text that fills its bag among them."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 200, 260)
    codes = [np.where(rng.random(size) < 0.18 * rng.random(), rng.integers(0, 200, size), base[:size]).astype("<u4") for size in rng.integers(100, 260, 120).tolist() + [80, 100, 160, 200]]
    codes += [np.full(400, 7, "<u4"), np.concatenate([np.full(400, 7), base[:60]]).astype("<u4")]
    labels = [i if i % 5 else 0 for i in range(len(codes))]
    met = spark.createDataFrame([(i, order_minhash.bag(c), c.tobytes()) for i, c in enumerate(codes)], "node long, bag binary, words binary")
    crowd = spark.createDataFrame([(i, len(c), k) for i, (c, k) in enumerate(zip(codes, labels))], "node long, n int, label long")
    names = [(i, j) for i in range(len(codes)) for j in range(i) if labels[i] != labels[j]]
    wanted = {p for p, s in zip(names, order_minhash.similar([(codes[i], codes[j]) for i, j in names])) if s is not None}
    got = [tuple(r) for r in order_minhash.links_in_blocks(spark, crowd, met).collect()]
    assert set(got) == wanted and len(got) == len(wanted) and 100 < len(wanted) < len(names)


def test_trimmed_ends():
    """The words that both texts begin and end with do not count, but they never count for both ends."""
    draw = np.random.default_rng(2)
    for _ in range(300):
        a, b = (draw.integers(0, 2, draw.integers(0, 12)).astype(np.uint32) for _ in range(2))
        x, y = order_minhash.trimmed(a, b)
        assert brute.edit_distance(x, y) == brute.edit_distance(a, b) and (not len(x) or not len(y) or (x[0] != y[0] and x[-1] != y[-1]))


def test_classes_carried_on(spark):
    """New links join classes that there are, and nodes that have none."""
    links = [(2, 1), (3, 2), (7, 6), (9, 8)]
    more = [(7, 3), (12, 11), (11, 9), (3, 1)]
    make = lambda x: spark.createDataFrame(x, "a long, b long")
    got = {tuple(r) for r in order_minhash.carried_on(spark, order_minhash.components(spark, make(links)), make(more)).collect()}
    assert got == {tuple(r) for r in order_minhash.components(spark, make(links + more)).collect()}
