"""What the operators of this subpackage share: tables, the shared folder, batches of bounded size, caches."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a Python operator holds at a time; one longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset a folder of our own in local mode, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir() or found
    return found.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"


def cut(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: it is computed once and a lost executor loses nothing of it."""
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables that cut() has written, when what was made of them is written too."""
    for t in tables:
        for path in {f.rpartition("/")[0] for f in t.inputFiles()}:
            remove(spark, path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now: it does so when their plans are collected in the driver."""
    gc.collect()
    spark._jvm.System.gc()


def text_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator on texts reads; a null text is an empty one."""
    return df.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text_col))


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about limit bytes of column each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < len(sizes):
            yield batch.slice(begin)


def map_steps(df: DataFrame, column: str, make: Callable[[pa.RecordBatch], Sequence], schema: str, limit: int = STEP_BYTES) -> DataFrame:
    """df through make, which gives the columns of schema for a slice of bounded bytes."""

    owner = make.__module__

    def run(batches):
        keep_caches_of(owner)
        with uncollected():
            for part in steps(batches, column, limit):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) if not isinstance(x, pa.Array) else x for x, t in zip(make(part), types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    fields = _parse_datatype_string(schema).fields
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    return df.mapInArrow(run, schema)


#: By module, what empties the caches that it keeps in a Python worker from task to task.
EMPTIED: dict[str, Callable[[], None]] = {}
HOLDER = [""]


def keep_caches_of(owner: str) -> None:
    """Empties what the other operators have left in this worker: Spark gives it to one after the other, and their caches would add up."""
    if HOLDER[0] == owner:
        return
    HOLDER[0] = owner
    for name, empty in EMPTIED.items():
        if name != owner:
            empty()
    gc.collect()
    pa.default_memory_pool().release_unused()


@contextlib.contextmanager
def uncollected():
    """Without Python's search for cycles: the operators make none, and it walks their lists again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class PieceCache:
    """Results by string, over whole lists of strings. There are two generations: when the younger holds over half of
    `most` strings or `most_chars` characters it becomes the older, and what the older had and nobody asked for goes."""

    def __init__(self, many: Callable[[list[str]], Iterable], most: int = 400_000, most_chars: int = 12_000_000):
        self.many, self.most, self.most_chars, self.known, self.older, self.chars = many, most // 2, most_chars // 2, {}, {}, 0

    def values(self, lists: Sequence[Sequence[str]]) -> list[list]:
        """The results for every list, in its order; every known string is looked up once."""
        if len(self.known) > self.most or self.chars > self.most_chars:
            self.known, self.older, self.chars = {}, self.known, 0
        known = self.known
        found = [list(map(known.get, x)) for x in lists]
        gaps = [[i for i, v in enumerate(f) if v is None] if None in f else () for f in found]
        new = {x[i] for x, g in zip(lists, gaps) for i in g}
        if new and self.older:
            again = set(filter(self.older.__contains__, new))
            known.update(zip(again, map(self.older.__getitem__, again)))
            self.chars += sum(map(len, again))
            new -= again
        if new:
            order = list(new)
            known.update(zip(order, self.many(order), strict=True))
            self.chars += sum(map(len, order))
        for x, f, g in zip(lists, found, gaps):
            for i in g:
                f[i] = known[x[i]]
        return found


def held_out(id_col: str | Column) -> Column:
    """Rows that no model is fitted on: crc32 of the id as text, modulo 5, is 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def store(path: str):
    """File system and path for a path as Spark writes it: file:/..., another URI that pyarrow knows, or a plain path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def put_file(path: str, data: bytes) -> None:
    """Writes a whole file under another name first, so a reader finds all of it or nothing."""
    files, at = store(path)
    files.create_dir(at.rpartition("/")[0], recursive=True)
    with files.open_output_stream(f"{at}.part") as f:
        f.write(data)
    files.move(f"{at}.part", at)


def read_range(path: str, offset: int, length: int) -> bytes:
    files, at = store(path)
    with files.open_input_file(at) as f:
        return f.read_at(length, offset)


def read_whole(path: str) -> bytes:
    files, at = store(path)
    with files.open_input_file(at) as f:
        return f.read()


def task_name() -> str:
    """A name for files of this attempt of this task: another attempt writes other files, and only the rows of one attempt count."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return f"part-{task.partitionId():06d}-{task.taskAttemptId():09d}"
