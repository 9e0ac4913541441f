"""Counts of a pass made in passing: the rows are counted as they are written, without reading them again."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OTHER = "other"


def counts(actions: Sequence[str], column: str = "action") -> list:
    """Aggregates: rows of each action, and of any other (null among them)."""
    known = F.coalesce(F.col(column).isin(*actions), F.lit(False))
    return [*(F.count_if(F.col(column) == a).alias(a) for a in actions), F.count_if(~known).alias(OTHER)]


def observed(batch: DataFrame, actions: Sequence[str], column: str = "action") -> tuple[DataFrame, Observation]:
    """The batch, to be written once, and what it will have counted by then: get() gives outcome_counts as a dict."""
    seen = Observation("outcomes")
    return batch.observe(seen, *counts(actions, column)), seen


def observed_stream(stream: DataFrame, actions: Sequence[str], column: str = "action", name: str = "outcomes") -> DataFrame:
    return stream.observe(name, *counts(actions, column))


def line_of(name: str, at: str, found: dict[str, int]) -> str:
    """The metrics line of a pass: its name, time and counts, those of zero left out."""
    return json.dumps({"name": name, "at": at, **{k: v for k, v in found.items() if v}})


class MetricLines(StreamingQueryListener):
    """Writes a line for each batch of a stream that has counted something under `name`. write: takes a line; it is called in the driver, once a batch."""

    def __init__(self, write, name: str = "outcomes"):
        self.write, self.name = write, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None and any(found.asDict().values()):
            self.write(line_of(event.progress.name or str(event.progress.id), event.progress.timestamp, found.asDict()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
