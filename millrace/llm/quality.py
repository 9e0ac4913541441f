"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Every text becomes a vector of statistics; cosines of random projections of the standardised vector approximate a
Gaussian kernel; each partition sums its part of the normal equations, which are solved on the driver (their size is
the square of the number of features, whatever the number of rows); counts by score bin on other labelled rows are
pooled to the isotonic curve that turns scores into probabilities. The curve is drawn through the middles of its steps,
and a hundredth of the score is a logistic curve of the raw one, so that the calibrated scores keep the raw ones' order.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import cut, held_out, map_steps, text_of

#: Share of held documents that are good: at this score and above a document is kept.
THRESHOLD = 0.3
FEATURES, SEED, WIDTH, RIDGE, BINS = 384, 20240, 3.5, 1e-3, 512
#: Partial sums of the equations, each of FEATURES squared numbers; all labelled rows are in them, however many there are.
PARTS = 256
#: Share of a score that orders texts of one step of the isotonic curve.
ORDER = 0.01
NAMES = ("log_words", "word_length", "log_longest_word", "distinct_words", "top_word", "repeats", "distinct_pairs", "upper", "digit", "mark", "symbol", "pipe", "non_ascii", "bare_words", "short_words", "log_line", "distinct_lines", "runs_of_marks", "log_alphabet", "capitals")
MARKS = re.compile(r"[^\w\s]{2,}")
LETTER = re.compile(r"[^\W\d_]")


def _classes() -> np.ndarray:
    """For code points under 768: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 mark, 6 symbol, 7 pipe."""
    t = np.zeros(769, np.int64)
    for c in range(768):
        x = chr(c)
        t[c] = 1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else 4 if x.isspace() else 7 if x == "|" else 6 if x in "#$%&*@^~<>{}[]\\=+_/" else 5 if not x.isalnum() and x.isprintable() else 0
    return t


CLASS = _classes()


def statistics(text: str) -> list[float]:
    """NAMES for one text; an empty text has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kinds = np.bincount(CLASS[np.minimum(points, 768)], minlength=8) / len(points)
    count = Counter(words)
    again = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    sizes = list(map(len, words))
    return [
        np.log1p(n), sum(sizes) / n, np.log1p(max(sizes)), len(count) / n**0.85, max(count.values()) / n, again / n, len(set(zip(words, words[1:]))) / n**0.95,
        kinds[2], kinds[3], kinds[5], kinds[6], kinds[7], float((points > 127).mean()),
        sum(k for w, k in count.items() if not LETTER.search(w)) / n, sum(1 for s in sizes if s <= 3) / n,
        np.log1p(len(text) / max(1, len(lines))), len(set(lines)) / max(1, len(lines)), len(MARKS.findall(text)) / n, np.log1p(len(np.unique(points))), sum(k for w, k in count.items() if len(w) > 1 and w.isupper()) / n,
    ]


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, stats for every row of docs."""
    return map_steps(text_of(docs, id_col, text_col), text_col, lambda part: (part.column(id_col), [statistics(t) for t in part.column(text_col).to_pylist()]), f"`{id_col}` long, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray | None  # None: nothing to learn from, every score is 0.5
    knots: np.ndarray = None  # raw scores and the calibrated ones
    values: np.ndarray = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        draw = np.random.Generator(np.random.PCG64(SEED))
        turn = draw.normal(0.0, 1.0 / WIDTH, (len(NAMES), FEATURES))
        shift = draw.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ turn + shift), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weight is None or not len(stats):
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        step = np.interp(raw, self.knots, self.values) if self.knots is not None else np.clip(raw, 0, 1)
        return np.round((1 - ORDER) * step + ORDER / (1 + np.exp(np.clip(4 * (0.5 - raw), -50, 50))), 6)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_pylist(), dtype=float).reshape(-1, len(NAMES))


def pooled(sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the first index of each block and the block's mean."""
    blocks: list[list[float]] = []
    for i, (s, n) in enumerate(zip(sums, counts)):
        blocks.append([i, s, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, s, n = blocks.pop()
            blocks[-1][1] += s
            blocks[-1][2] += n
    return np.array([b[0] for b in blocks], dtype=int), np.array([b[1] / b[2] for b in blocks])


def fit(spark: SparkSession, stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """A model from the labelled rows of stats that are not held out. Labels that are null count for nothing; of several for one id the largest holds.

    Of these rows, those whose crc32 leaves 1 modulo 5 calibrate, the others give the weights; all of them are used.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias(id_col)).agg(F.max(F.col(label_col).cast("double")).alias("label"))
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    rows = cut(spark, stats.join(known, id_col).where(~held_out(id_col)).select("stats", "label", (rest == 1).alias("calibrates")), "quality-rows")
    learn = rows.where(~F.col("calibrates"))
    sums = learn.agg(F.count("*").alias("n"), *(f(F.col("stats")[i]).alias(f"{k}{i}") for i in range(len(NAMES)) for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if not sums["n"]:
        return Model(np.zeros(len(NAMES)), np.ones(len(NAMES)), None)
    model = Model(np.array([sums[f"m{i}"] for i in range(len(NAMES))]), np.array([max(sums[f"s{i}"], 1e-3) for i in range(len(NAMES))]), None)
    size = FEATURES + 1

    def partial(batches):
        total = np.zeros((size, size + 1))
        for b in batches:
            if b.num_rows:
                x, y = model.features(matrix(b.column("stats"))), np.asarray(b.column("label"), dtype=float)
                total[:, :size] += x.T @ x
                total[:, size] += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "sums"])

    def added(row, parts):
        total = np.zeros(size + 1)
        for chunk in parts.column("sums").chunks:
            total += np.asarray(chunk.flatten()).reshape(-1, size + 1).sum(axis=0)
        return pa.table([pa.array([row[0].as_py()], pa.int32()), pa.array([list(total)], pa.list_(pa.float64()))], names=["row", "sums"])

    # tasks are joined before they sum, so the sums that are moved are bounded at every size
    parts = learn.select("stats", "label").coalesce(PARTS).mapInArrow(partial, "row int, sums array<double>").groupBy("row").applyInArrow(added, "row int, sums array<double>").collect()
    total = np.zeros((size, size + 1))
    for r in parts:
        total[r["row"]] = r["sums"]
    ridge = np.diag([RIDGE * sums["n"]] * FEATURES + [1e-9])
    model.weight = np.linalg.solve(total[:, :size] + ridge, total[:, size])

    def bins(batches):
        n, y = np.zeros(BINS, dtype=np.int64), np.zeros(BINS)
        for b in batches:
            if b.num_rows:
                at = np.clip(((model.raw(matrix(b.column("stats"))) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
                n += np.bincount(at, minlength=BINS)
                y += np.bincount(at, weights=np.asarray(b.column("label"), dtype=float), minlength=BINS)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used], pa.int64()), pa.array(y[used], pa.float64())], names=["bin", "n", "y"])

    found = rows.where("calibrates").select("stats", "label").mapInArrow(bins, "bin int, n long, y double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    if found:
        at, n, y = (np.array([r[c] for r in found], dtype=float) for c in ("bin", "n", "y"))
        model.knots, model.values = curve((at + 0.5) / BINS * 2 - 0.5, n, y)
    return model


def curve(raw: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The isotonic curve of sums y over counts n at ascending raw scores: the mean raw score of every step, and its mean."""
    first, values = pooled(y, n)
    return np.add.reduceat(raw * n, first) / np.add.reduceat(n, first), np.clip(values, 0, 1)


def score_vectors(stats: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id, score for every row of stats."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(model.score(matrix(b.column("stats"))), pa.float64())], names=[id_col, "score"])

    return stats.select(id_col, "stats").mapInArrow(run, f"`{id_col}` long, score double")


def score_of(model: Model, text_col: str = "text"):
    """Column: the score of a text; a null text is an empty one."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([statistics(t or "") for t in texts.to_pylist()]).reshape(-1, len(NAMES))), pa.float64())

    return run(F.col(text_col))


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted for every row of docs.

    A null text is an empty one. A null id stays null, is not held out and has no label. Repeated rows give repeated
    results. Without any usable label every score is 0.5. Other columns are not read, whatever their names; an empty
    table gives an empty result.
    """
    stats = cut(spark, vectors(docs, id_col, text_col), "quality-stats")
    scored = score_vectors(stats, fit(spark, stats, labels, id_col), id_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

