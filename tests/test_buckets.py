"""Stores of buckets: what a batch reads and writes, crashes, repeats, old folders."""

import json
import random
from pathlib import Path

import pytest

from millrace import schemas
from millrace.operators import merge
from millrace.sources.buckets import BucketStore, ItemStore
from millrace.streaming import ingest

KIND = "seq long, url string, title string, doi string, content_body string, domain_tags array<string>"


def rows_of(df):
    return sorted(str(r.asDict()) for r in df.collect())


def drawn(draw, n, urls):
    return [(k, f"https://a/{draw.randrange(urls)}", f"t{k}", f"10.1/{draw.randrange(urls)}" if draw.random() < 0.5 else None, f"b{k}" if k % 3 else None, [f"g{k % 4}"]) for k in range(n)]


def size(folder: Path) -> int:
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_same_as_whole_merges(spark, tmp_path):
    """Batches that share URLs and DOIs, with and without the columns that count, against merges of whole tables."""
    draw = random.Random(4)
    store, whole = ItemStore(spark, str(tmp_path), buckets=8), spark.createDataFrame([], schemas.ITEMS)
    for number in range(4):
        batch = spark.createDataFrame(drawn(draw, 40, 60), KIND)
        if number == 2:
            batch = batch.drop("doi", "content_body")
        assert store.merge(batch, number) and not store.merge(batch, number)
        whole = schemas.conform(spark.createDataFrame(merge.merge_items(whole, batch).collect(), schemas.ITEMS), schemas.ITEMS)
        assert rows_of(store.read("items")) == rows_of(whole)
        assert rows_of(store.read("dois")) == rows_of(whole.where("doi IS NOT NULL").select("doi", "url"))
    assert store.merge(spark.createDataFrame([(0, None, "t", None, None, None)], KIND), 9) and rows_of(store.read("items")) == rows_of(whole)


def test_a_batch_writes_its_buckets_only(spark, tmp_path):
    """Bytes written follow the batch, not the table; nothing else is opened."""
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(400))
    written = {}
    for n in (2_000, 16_000):
        path = tmp_path / str(n)
        store = ItemStore(spark, str(path), buckets=n // 50)
        whole = spark.range(n).selectExpr("concat('https://a/', id) AS url", f"concat('{text}', id) AS content_body", "concat('10.1/', id) AS doi", "id")
        assert store.load(schemas.conform(whole, schemas.ITEMS))
        before = size(path)
        assert store.merge(spark.createDataFrame([(0, "https://a/5", "t", None, "new", None), (1, "https://b/1", "t", "10.1/5", "taken", None), (2, "https://b/2", "t", "10.2/5", "free", None)], KIND), 1)
        written[n] = size(path) - before
        opened = {f.rpartition("/")[0].rpartition("/")[2] for f in store.read("items", store.touched(items=(store.read("items").where("url = 'https://a/5'"), "url"))["items"]).inputFiles()}
        assert len(opened) == 1 and written[n] < before / 8
        got = {r["url"]: r for r in store.read("items").where("url LIKE 'https://b/%' OR url = 'https://a/5'").collect()}
        assert sorted(got) == ["https://a/5", "https://b/2"] and got["https://a/5"]["content_body"] == "new" and got["https://a/5"]["needs_rechunk"]
        assert store.read("items").count() == n + 1
    assert written[16_000] < 2 * written[2_000]


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    store = ItemStore(spark, str(tmp_path), buckets=4)
    batch = lambda k: spark.createDataFrame([(0, f"https://a/{k}", "t", f"10.1/{k}", None, None)], KIND)
    assert store.merge(batch(0), 0)

    def dies(*_):
        raise RuntimeError("lost")

    for step in ("publish", "commit", "buckets_in"):
        with monkeypatch.context() as m:
            m.setattr(BucketStore, step, dies)
            with pytest.raises(RuntimeError):
                store.merge(batch(1), 1)
        again = ItemStore(spark, str(tmp_path), buckets=999)  # the number of buckets is the first manifest's
        assert [r["url"] for r in again.read("items").collect()] == ["https://a/0"] and again.manifest()["buckets"] == 4
    assert store.merge(batch(1), 1) and store.read("items").count() == 2


def test_old_folders_expire(spark, tmp_path):
    store = ItemStore(spark, str(tmp_path), buckets=4, keep=2)
    for k in range(6):
        assert store.merge(spark.createDataFrame([(0, "https://a/same", f"t{k}", None, f"body {k}", None), (1, f"https://a/{k}", "t", f"10.1/{k}", None, None)], KIND), k)
    older = rows_of(store.read("items", number=4))
    assert store.expire() and store.expire() == []
    assert store.numbers() == [4, 5] and rows_of(store.read("items", number=4)) == older and store.read("items").count() == 7
    used = {f for n in (4, 5) for t in store.manifest(n)["tables"].values() for f in t.values()}
    there = {str(p.relative_to(tmp_path)) for p in (tmp_path / "data").glob("*/*/__bucket=*")}
    assert used == there
    assert store.merge(spark.createDataFrame([(0, "https://a/x", "t", None, None, None)], KIND), 6) and store.read("items").count() == 8


def test_stream_into_buckets(spark, tmp_path):
    draw = random.Random(7)
    rows = drawn(draw, 60, 25)
    (tmp_path / "in").mkdir()
    for k in range(3):
        part = [json.dumps(dict(zip(("seq", "url", "title", "doi", "content_body", "domain_tags"), r))) for r in rows[k * 20 : k * 20 + 20]]
        spark.read.schema(KIND).json(spark.sparkContext.parallelize(part, 1)).coalesce(1).write.parquet(f"{tmp_path}/raw{k}")
        (file,) = (tmp_path / f"raw{k}").glob("*.parquet")
        (tmp_path / "in" / f"{k}.parquet").write_bytes(file.read_bytes())
    store = ItemStore(spark, f"{tmp_path}/table", buckets=8)
    for _ in range(2):  # started again, it finds nothing new
        ingest.ingest(spark, f"{tmp_path}/in", store, f"{tmp_path}/checkpoint", spark.createDataFrame([], KIND).schema).awaitTermination()
        whole = merge.merge_items(spark.createDataFrame([], schemas.ITEMS), spark.createDataFrame(rows, KIND))
        assert rows_of(store.read("items")) == rows_of(whole)
