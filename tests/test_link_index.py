"""Links kept up batch by batch against links of all items at once."""

import random

from millrace.operators import dedup
from millrace.operators.link_index import LinkIndex


def drawn(draw, n):
    """Texts with copies, near copies, and runs that many share; keys in no order."""
    words = [f"w{k}" for k in range(300)]
    common, docs = [draw.choice(words) for _ in range(14)], {}
    for k in range(n):
        base = [draw.choice(words) for _ in range(draw.randrange(8, 60))]
        if k % 4 and docs:
            base = list(docs[draw.choice(list(docs))])
            for _ in range(draw.randrange(0, 4)):
                base[draw.randrange(len(base))] = draw.choice(words)
        docs[draw.randrange(10**6)] = base if k % 5 else common + base
    return {k: " ".join(v) + "!" * 60 for k, v in docs.items()}


def links(df):
    return {tuple(r) for r in df.collect()}


def test_batches_make_the_links_of_all(spark, tmp_path):
    rows = list(drawn(random.Random(2), 120).items())
    index = LinkIndex(spark, str(tmp_path / "index"), buckets=16)
    seen = []
    for number, part in enumerate((rows[:50], rows[50:55], rows[55:])):
        prints = dedup.fingerprints(spark.createDataFrame(part, "id long, content_body string"))
        assert index.add(prints, number) and not index.add(prints, number)
        seen += part
        whole = dedup.fingerprints(spark.createDataFrame(seen, "id long, content_body string"))
        assert links(index.links()) == links(dedup.near_duplicates(whole))
    assert len(links(index.links())) > 20


def test_a_batch_opens_what_it_needs(spark, tmp_path, monkeypatch):
    """One new item among many: few of the buckets are read and written, and nothing of the others."""
    draw = random.Random(5)
    text = lambda: " ".join(f"w{draw.randrange(5000)}" for _ in range(40))
    rows = [(k, text()) for k in range(400)]
    index = LinkIndex(spark, str(tmp_path / "index"), buckets=64)
    index.add(dedup.fingerprints(spark.createDataFrame(rows, "id long, content_body string")), 0)
    opened = {"groups": set(), "runs": set(), "items": set()}
    read = LinkIndex.read

    def counted(self, name, only=None, number=None):
        if name in opened:
            opened[name] |= set(range(64)) if only is None else set(only)
        return read(self, name, only, number)

    near = rows[7][1].split()
    near[20] = "other"
    with monkeypatch.context() as m:
        m.setattr(LinkIndex, "read", counted)
        assert index.add(dedup.fingerprints(spark.createDataFrame([(1000, " ".join(near))], "id long, content_body string")), 1)
    assert len(opened["groups"]) <= 2 and len(opened["items"]) == 1 and len(opened["runs"]) <= 14
    assert links(index.links()) == {(1000, 7)}
    before, after = (index.manifest(n)["tables"] for n in (0, 1))
    assert sum(before["groups"][b] != f for b, f in after["groups"].items()) <= 2


def test_empty_batches(spark, tmp_path):
    index = LinkIndex(spark, str(tmp_path / "index"), buckets=4)
    none = dedup.fingerprints(spark.createDataFrame([], "id long, content_body string"))
    assert index.add(none, 0) and links(index.links()) == set()
    text = " ".join(f"w{k}" for k in range(50))
    assert index.add(dedup.fingerprints(spark.createDataFrame([(3, text), (1, text), (2, "short")], "id long, content_body string")), 1)
    assert links(index.links()) == {(3, 1)} and index.add(none, 2) and links(index.links()) == {(3, 1)}
