"""Time passes without rows: give-ups, leases and time limits."""

import datetime as dt
import time

from millrace.streaming import timers

START = dt.datetime(2024, 1, 1)


def at(hours: float) -> dt.datetime:
    return START + dt.timedelta(hours=hours)


def stream_of(spark, folder, schema):
    """A stream over a folder, and what puts rows into it."""
    folder.mkdir()
    count = iter(range(100))

    def put(*rows):
        made = folder.parent / f"{folder.name}-{next(count)}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(made))
        (file,) = made.glob("*.parquet")
        file.rename(folder / f"{made.name}.parquet")

    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder)), put


def run(df, name, folder, **trigger):
    return df.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", str(folder)).trigger(**trigger or {"availableNow": True}).start()


def test_silent_domains_are_given_up(spark, tmp_path):
    fetches, put = stream_of(spark, tmp_path / "in", "domain string, ok boolean, http_status int, at timestamp")
    put(("silent", False, 403, at(0)), ("alive", False, 500, at(0)), ("works", True, 200, at(0)))
    put(("alive", True, 200, at(5)), ("silent", False, 500, at(6)))
    put(("works", False, 403, at(30)), ("late", False, 403, at(20)))  # nobody asks for silent any more
    put(("works", False, 403, at(45)))
    q = run(timers.give_ups(fetches), "given", tmp_path / "checkpoint")
    q.awaitTermination()
    last = {}
    for r in spark.table("given").collect():
        if r["domain"] not in last or r["changed_at"] >= last[r["domain"]]["changed_at"]:
            last[r["domain"]] = r
    assert {d: (r["given_up"], r["given_up_at"]) for d, r in last.items()} == {"silent": (True, at(24)), "alive": (False, None), "works": (False, None), "late": (True, at(44))}
    assert (last["silent"]["consecutive_403_count"], last["works"]["consecutive_403_count"], last["alive"]["ever_succeeded"]) == (1, 2, True)


def test_leases_and_time_limits(spark, tmp_path):
    events, put = stream_of(spark, tmp_path / "in", "id long, event string, at timestamp")
    put((1, "found", at(0)), (1, "claimed", at(1)), (2, "found", at(0)), (2, "claimed", at(1)), (3, "found", at(0)), (4, "found", at(0)))
    put((2, "finished", at(1.1)), (9, "found", at(2)))  # the lease of 1 is over
    put((1, "claimed", at(3)), (9, "claimed", at(3.01)))
    put((1, "finished", at(3.1)), (4, "claimed", at(24 * 14 - 0.05)))
    put((8, "found", at(24 * 14 + 0.01)))  # the limits of 3 and 4 have passed; 4 has a lease
    put((8, "finished", at(24 * 14 + 5)), (7, "found", at(24 * 15)))
    q = run(timers.requests(events), "asked", tmp_path / "checkpoint")
    q.awaitTermination()
    got = {}
    for r in sorted(spark.table("asked").collect(), key=lambda r: r["changed_at"]):
        got.setdefault(r["id"], []).append((r["status"], r["reason"], round((r["changed_at"] - START).total_seconds() / 3600, 2)))
    assert got[1] == [("pending", None, 0), ("processing", None, 1), ("pending", "lease_lost", 1.17), ("processing", None, 3), ("done", None, 3.1)]
    assert got[2] == [("pending", None, 0), ("processing", None, 1), ("done", None, 1.1)]
    assert got[3] == [("pending", None, 0), ("failed", "stale_ttl_exceeded", 336)]
    assert [x[:2] for x in got[4]] == [("pending", None), ("processing", None), ("pending", "lease_lost"), ("failed", "stale_ttl_exceeded")]
    assert got[9][:3] == [("pending", None, 2), ("processing", None, 3.01), ("pending", "lease_lost", 3.18)]


def test_the_clock_alone_takes_leases_back(spark, tmp_path):
    """By the clock: one batch of rows, then nothing. (Such a stream never ends by itself: it has to wake its timers.)"""
    events, put = stream_of(spark, tmp_path / "in", "id long, event string, at timestamp")
    put((1, "found", at(0)), (1, "claimed", at(0)), (2, "claimed", at(0)))
    stream = timers.requests(events, mode="ProcessingTime", lease_ms=3_000)
    q = run(stream, "clock", tmp_path / "checkpoint", processingTime="1 second")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("clock").where("status = 'pending' AND reason IS NOT NULL").count() < 2:
            time.sleep(1)
    finally:
        q.stop()
    got = {(r["id"], r["status"], r["reason"]) for r in spark.table("clock").collect()}
    assert got >= {(1, "processing", None), (2, "processing", None), (1, "pending", "lease_lost"), (2, "pending", "lease_lost")}
