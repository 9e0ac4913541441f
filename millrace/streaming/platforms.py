"""Sources as streams: saved responses of many surfaces, read on from their cursors.

Under a root every surface has a folder with surface.json (platform, config) and one file for each response, an envelope
{"status", "url", "body"}, named by the run and the cursor that was asked for: 0/first.json, 0/t3_abc.json, and after
the last page of a run 1/first.json. The stream's offset is the cursors: for every surface the run, the cursor to ask for
next, and the number of responses so far. A good response moves its surface's cursor by the rule of its platform; an
error, or a file that is not there yet, leaves it where it is, and the error is reported once. The checkpoint holds the
offsets, so after a failure nothing is lost and nothing read twice.

The driver reads responses only for their cursors; rows are read by tasks, one response each.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.state import after_runs
from millrace.sources import cursors, payloads
from millrace.sources.buckets import ItemStore

RESPONSES = "surface_key string, platform string, config string, seq long, url string, body string, cursor string, error string"


def at(body, *path, default=None):
    """What stands at a path of parsed JSON; the default where something else does."""
    for p in path:
        if isinstance(body, dict):
            body = body.get(p)
        elif isinstance(body, list) and isinstance(p, int) and p < len(body):
            body = body[p]
        else:
            return default
    return default if body is None else body


def found(body, *path) -> int:
    records = at(body, *path)
    return len(records) if isinstance(records, list) else 0


def number(value, default: int) -> int:
    try:
        return int(value)
    except (TypeError, ValueError):
        return default


#: platform: (cursor, body, config, envelope) to the next cursor; none ends the run.
PAGED: dict[str, Callable] = {
    "reddit": lambda c, b, g, e: cursors.opaque(at(b, "data", "after")),
    "youtube": lambda c, b, g, e: cursors.opaque(at(b, "nextPageToken")),
    "clinicaltrials": lambda c, b, g, e: cursors.opaque(at(b, "nextPageToken")),
    "europepmc": lambda c, b, g, e: cursors.mark(c, at(b, "nextCursorMark")),
    "openalex": lambda c, b, g, e: cursors.mark(c, at(b, "meta", "next_cursor")),
    "crossref": lambda c, b, g, e: cursors.mark(c, at(b, "message", "next-cursor")) if found(b, "message", "items") else None,
    "semanticscholar": lambda c, b, g, e: cursors.offset(c, found(b, "data"), number(at(b, "total"), 0)),
    "core": lambda c, b, g, e: cursors.offset(c, found(b, "results"), number(at(b, "totalHits"), 0)),
    "pubmed": lambda c, b, g, e: cursors.offset(c, (e.get("body") or "").count("</PubmedArticle>"), number(e.get("total"), 0)),
    "doaj": lambda c, b, g, e: cursors.page(c, found(b, "results"), number(g.get("limit"), 100), number(at(b, "total"), 0)),
    "newsapi": lambda c, b, g, e: cursors.page(c, found(b, "articles"), number(g.get("limit"), 100), number(at(b, "totalResults"), 0)),
    "hackernews": lambda c, b, g, e: cursors.page_of(c, number(at(b, "nbPages"), 0)),
    "biorxiv": lambda c, b, g, e: cursors.date_offset(c, g.get("start", ""), found(b, "collection"), number(at(b, "messages", 0, "total"), 0)),
    "wikipedia": lambda c, b, g, e: cursors.title_after(g.get("titles") or [], at(b, "title")),
}
#: The same for platforms where every response is a run of its own and the cursor goes on from run to run.
POLLED: dict[str, Callable] = {
    "rss": lambda c, b, g, e: cursors.newest(c, [e.get("newest")]),
    "cdc_data": lambda c, b, g, e: cursors.row_offset(c, number(g.get("limit"), 100), bool(e.get("rows", "[]") != "[]")),
    **dict.fromkeys(("html_pages", "browser_pages", "sitemap", "nhs_api"), lambda c, b, g, e: e.get("url") or c),
}


def moved(platform: str, cursor: str | None, envelope: dict, config: dict) -> tuple[str | None, bool]:
    """The cursor after a good response, and whether its run has ended."""
    try:
        body = json.loads(envelope.get("body") or "null")
    except ValueError:
        body = None
    if platform in POLLED:
        return POLLED[platform](cursor, body, config, envelope), True
    then = PAGED[platform](cursor, body, config, envelope)
    return then, then is None


def open_store(root: str):
    """File system and path of a root: a plain path, file:, or another address that Arrow knows."""
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def read_text(root: str, name: str) -> str | None:
    files, top = open_store(root)
    try:
        with files.open_input_file(f"{top}/{name}") as f:
            return f.read().decode("utf-8", "replace")
    except FileNotFoundError:
        return None


def envelope_of(text: str) -> tuple[dict, str | None]:
    """A saved response and what is wrong with it."""
    try:
        envelope = json.loads(text)
    except ValueError:
        return {}, "envelope malformed"
    if not isinstance(envelope, dict):
        return {}, "envelope malformed"
    status = number(envelope.get("status", 200), 0)
    return envelope, None if 200 <= status < 300 else f"http_{status}"


@dataclass
class Response(InputPartition):
    """One response to read, or an error to report."""

    surface: str
    platform: str
    config: str
    name: str
    seq: int
    cursor: str | None
    error: str | None = None


class SurfaceReader(DataSourceStreamReader):
    """Offsets: surface to {run, cursor, seq, error}."""

    def __init__(self, root: str, pages: int):
        self.root, self.pages, self.where = root, pages, None

    def initialOffset(self) -> dict:
        return {}

    def surfaces(self) -> dict[str, tuple[str, str]]:
        from pyarrow import fs

        files, top = open_store(self.root)
        out = {}
        for f in files.get_file_info(fs.FileSelector(top, allow_not_found=True)):
            said = read_text(self.root, f"{f.base_name}/surface.json") if f.type == fs.FileType.Directory else None
            if said:
                surface = json.loads(said)
                if surface["platform"] in PAGED or surface["platform"] in POLLED:
                    out[f.base_name] = (surface["platform"], json.dumps(surface.get("config") or {}))
        return out

    def walk(self, key: str, platform: str, config: str, start: dict, most: int) -> Iterator[tuple[Response, dict]]:
        """Responses from a surface's offset on, each with the offset after it; an error not reported yet is the last."""
        now = {"run": 0, "cursor": None, "seq": 0, "error": None} | start
        for _ in range(most):
            name = f"{key}/{now['run']}/{quote(now['cursor'], safe='') if now['cursor'] else 'first'}.json"
            text = read_text(self.root, name)
            if text is None:
                return
            envelope, wrong = envelope_of(text)
            if wrong:
                error = f"{wrong} {name} {zlib.crc32(text.encode()):08x}"
                if error != now["error"]:
                    now = now | {"error": error}
                    yield Response(key, platform, config, name, now["seq"], now["cursor"], wrong), now
                return
            then, ended = moved(platform, now["cursor"], envelope, json.loads(config))
            now = {"run": now["run"] + ended, "cursor": then, "seq": now["seq"] + 1, "error": None}
            yield Response(key, platform, config, name, now["seq"], then), now

    def latestOffset(self) -> dict:
        if self.where is None:
            self.where = self.initialOffset()
        then = dict(self.where)
        for key, (platform, config) in sorted(self.surfaces().items()):
            for _, offset in self.walk(key, platform, config, self.where.get(key, {}), self.pages):
                then[key] = offset
        self.where = then
        return then

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.where is None:  # started again: the engine asks for the last batch of its log first
            self.where = end
        out = []
        surfaces = self.surfaces()
        for key, to in sorted(end.items()):
            at_ = start.get(key, {"seq": 0, "error": None})
            if key not in surfaces:
                continue
            responses = self.walk(key, *surfaces[key], start.get(key, {}), to["seq"] - at_["seq"])
            out += [r for r, _ in responses if r.error is None]
            if to["error"] and to["error"] != at_["error"]:
                wrong, name, _ = to["error"].rsplit(" ", 2)
                out.append(Response(key, *surfaces[key], name, to["seq"], to["cursor"], wrong))
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        r = partition
        if r.error:
            yield (r.surface, r.platform, r.config, r.seq, None, None, r.cursor, r.error)
            return
        envelope, _ = envelope_of(read_text(self.root, r.name) or "{}")
        yield (r.surface, r.platform, r.config, r.seq, envelope.get("url"), envelope.get("body"), r.cursor, None)

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint has the offsets, the files stay."""


class SurfaceSource(DataSource):
    """format("surfaces"): options path, and pages (responses of a surface in a batch, 20)."""

    @classmethod
    def name(cls) -> str:
        return "surfaces"

    def schema(self) -> str:
        return RESPONSES

    def streamReader(self, schema) -> SurfaceReader:
        return SurfaceReader(self.options["path"], int(self.options.get("pages", 20)))


def responses(spark: SparkSession, root: str, pages: int = 20) -> DataFrame:
    """The stream of responses (RESPONSES), errors among them."""
    spark.dataSource.register(SurfaceSource)
    return spark.readStream.format("surfaces").option("path", root).option("pages", pages).load()


def marked_items(batch: DataFrame, more: dict[str, tuple[DataFrame, ...]] | None = None) -> DataFrame | None:
    """Items and rejects of a batch of responses, platform by platform (there are 20 at most); column platform says whose."""
    spark, out = batch.sparkSession, None
    for (platform,) in sorted(batch.where("error IS NULL").select("platform").distinct().collect()):
        own = batch.where((F.col("platform") == platform) & F.col("error").isNull())
        tables = (more or {}).get(platform, ())
        if platform == "youtube" and not tables:
            tables = (spark.createDataFrame([], "id string, view_count long"), spark.createDataFrame([], "id string, text string"))
        if platform == "wikipedia" and "extract" not in own.columns:
            own = own.withColumn("extract", F.get_json_object("body", "$.extract"))
        if platform == "cdc_data" and "rows" not in own.columns:
            own = own.withColumn("rows", F.lit("[]"))
        rows = payloads.marked(platform, own, *tables).withColumn("platform", F.lit(platform))
        out = rows if out is None else out.unionByName(rows)
    return out


def outcomes(batch: DataFrame, items: DataFrame) -> DataFrame:
    """What a batch has done for each surface, for after_runs: key, items (null on error), cursor, error."""
    said = batch.groupBy(F.col("surface_key").alias("key")).agg(F.max_by("cursor", F.when(F.col("error").isNull(), F.col("seq"))).alias("cursor"), F.max_by("error", "seq").alias("error"))
    counts = items.groupBy(F.col("surface_key").alias("key")).agg(F.count("*").cast("int").alias("n"))
    return said.join(counts, "key", "left").select("key", F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0))).alias("items"), "cursor", "error")


def collect_into(store: ItemStore, rejects: str, surfaces=None, more: dict[str, tuple[DataFrame, ...]] | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: items into the store, rejects into a folder of their batch, run states into surfaces (a Snapshots of the
    table of surfaces and its schema), if there is one.

    Rows are made once and written; a batch that comes again writes the same folder and merges nothing.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            rows = marked_items(batch, more)
            if rows is not None:
                made = f"{rejects}/.made/batch={number}"
                rows.write.mode("overwrite").parquet(made)
                rows = spark.read.schema(rows.schema).parquet(made)
                bad = rows.where(F.col(payloads.REJECT).isNotNull()).select("platform", "surface_key", "seq", f"{payloads.REJECT}.reason", f"{payloads.REJECT}.record", f"{payloads.REJECT}.raw")
                bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
                items = rows.where(F.col(payloads.REJECT).isNull()).drop(payloads.REJECT, "platform")
                store.merge(items, number)
            else:
                items = spark.createDataFrame([], "surface_key string")
            if surfaces is not None:
                states, schema = surfaces
                # kept by its own number: a batch that comes again after its items were merged still counts, once
                states.write(after_runs(states.read(schema), outcomes(batch, items), F.current_timestamp()), number + 1)
            store.expire()
        finally:
            batch.unpersist()

    return run


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """All rejects of a stream: platform, surface, response and record, the reason and the raw text."""
    return spark.read.schema(f"{payloads.REJECTS}, batch int").parquet(rejects)


def collect(spark: SparkSession, root: str, store: ItemStore, rejects: str, checkpoint: str, pages: int = 20, every: str | None = None, surfaces=None, more=None) -> StreamingQuery:
    """Responses under root into the store. every: how often it looks for new ones; without it, it ends when all that is there is in."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    write = responses(spark, root, pages).writeStream.foreachBatch(collect_into(store, rejects, surfaces, more))
    return write.option("checkpointLocation", checkpoint).trigger(**trigger).start()
