"""State machines as pure transitions: the state before and the outcomes of a pass give the state after. Time is an argument."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.records import next_retry, status_of_reason

GIVE_UP_HOURS, GIVE_UP_ATTEMPTS, DAILY_PROMOTIONS = 24, 3, 5


def after_runs(surfaces: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Sources after their runs. outcomes: key, items (null on error), cursor, error. The cursor moves on success only; an error counts up, also stamps the time."""
    names = surfaces.columns
    o = outcomes.select("key", F.col("items").alias("__items"), F.col("cursor").alias("__cursor"), F.col("error").alias("__error"), F.lit(True).alias("__ran"))
    ran, failed = F.col("__ran").isNotNull(), F.col("__error").isNotNull()
    good = ran & ~failed
    new = {
        "last_run_at": F.when(ran, as_of).otherwise(F.col("last_run_at")),
        "last_cursor": F.when(good, F.col("__cursor")).otherwise(F.col("last_cursor")),
        "last_status": F.when(failed, "error").when(good & (F.col("__items") > 0), "ok").when(good, "empty").otherwise(F.col("last_status")),
        "last_error": F.when(failed, F.substring("__error", 1, 500)).when(good, None).otherwise(F.col("last_error")),
        "last_run_count": F.when(good, F.col("__items")).otherwise(F.col("last_run_count")),
        "consecutive_fails": F.when(failed, F.col("consecutive_fails") + 1).when(good, 0).otherwise(F.col("consecutive_fails")),
        "force_run": F.when(good, False).otherwise(F.col("force_run")),
    }
    return surfaces.join(o, "key", "left").withColumns({k: v for k, v in new.items() if k in names}).select(*names)


def tally(fetches: DataFrame) -> DataFrame:
    """A batch's fetches (domain, ok, http_status) by domain: succeeded, failed, refused (403)."""
    return fetches.groupBy("domain").agg(F.bool_or("ok").alias("succeeded"), F.bool_or(~F.col("ok")).alias("failed"), F.count_if(F.col("http_status") == 403).cast("int").alias("refused"))


def domain_states(stored: DataFrame, batch: DataFrame, as_of: Column) -> DataFrame:
    """Domain states after a batch, for the domains it touched. A success in the batch beats its failures and is remembered for ever; a domain that never succeeded is given up 24 hours after its first failure."""
    b = batch.select("domain", "succeeded", "refused")
    joined = b.join(stored, "domain", "left")
    ok = F.coalesce("succeeded", F.lit(False))
    ever = F.coalesce("ever_succeeded", F.lit(False)) | ok
    first = F.when(ok, F.col("first_failure_at")).otherwise(F.coalesce("first_failure_at", as_of))
    gives_up = ~ok & ~ever & (first <= as_of - F.expr(f"INTERVAL {GIVE_UP_HOURS} HOURS"))
    given = F.coalesce("given_up", F.lit(False))
    return joined.select(
        "domain", F.when(ok, 0).otherwise(F.coalesce("consecutive_403_count", F.lit(0)) + F.col("refused")).cast("int").alias("consecutive_403_count"), (given | gives_up).alias("given_up"),
        F.when(given, F.col("given_up_at")).when(gives_up, as_of).alias("given_up_at"), as_of.alias("last_checked_at"), ever.alias("ever_succeeded"), first.alias("first_failure_at"),
    )


def newly_given_up(before: DataFrame, after: DataFrame) -> DataFrame:
    return after.where("given_up").select("domain").join(before.where("given_up").select("domain"), "domain", "left_anti")


def skipped_domains(states: DataFrame, manual: DataFrame) -> DataFrame:
    return states.where("given_up").select("domain").union(manual.select("domain")).distinct()


def attempts_after_failure(attempts: Column, body: Column, most: int = GIVE_UP_ATTEMPTS) -> tuple[Column, Column]:
    """(attempts, body) after a failed fetch: the last attempt leaves the empty body that says never again."""
    n = F.coalesce(attempts, F.lit(0)) + 1
    return n, F.when(n >= most, F.lit("")).otherwise(body)


def recover_leases(requests: DataFrame, as_of: Column, minutes: int = 10, since: str = "discovered_at") -> DataFrame:
    """Requests in process for too long wait again. since: measured from when they were found, or from claimed_at."""
    late = (F.col("status") == "processing") & (F.col(since) < as_of - F.expr(f"INTERVAL {minutes} MINUTES"))
    return requests.withColumn("status", F.when(late, "pending").otherwise(F.col("status")))


def expire(requests: DataFrame, as_of: Column, days: int = 14) -> DataFrame:
    late = (F.col("status") == "pending") & (F.col("discovered_at") < as_of - F.expr(f"INTERVAL {days} DAYS"))
    return requests.withColumns({"status": F.when(late, "failed").otherwise(F.col("status")), "error_note": F.when(late, "stale_ttl_exceeded").otherwise(F.col("error_note")), "processed_at": F.when(late, as_of).otherwise(F.col("processed_at"))})


def finish(requests: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Requests after processing. outcomes: id, outcome (done, out_of_scope or failed), reason."""
    o = outcomes.select("id", F.col("outcome").alias("__outcome"), F.col("reason").alias("__reason"))
    hit, failed = F.col("__outcome").isNotNull(), F.col("__outcome") == "failed"
    before = F.coalesce("retry_count", F.lit(0))
    new = {
        "status": F.coalesce("__outcome", "status"),
        "processed_at": F.when(hit, as_of).otherwise(F.col("processed_at")),
        "next_retry_at": F.when(failed, next_retry(F.col("__reason"), before, as_of)).when(hit, None).otherwise(F.col("next_retry_at")),
        "last_http_status": F.when(failed, status_of_reason(F.col("__reason"))).otherwise(F.col("last_http_status")),
        "error_note": F.when(F.col("__outcome") == "done", None).when(hit, F.col("__reason")).otherwise(F.col("error_note")),
        "retry_count": F.when(failed, before + 1).otherwise(F.col("retry_count")),
    }
    return requests.join(o, "id", "left").withColumns({k: v for k, v in new.items() if k in requests.columns}).select(*requests.columns)


def may_promote(tier: Column, confidence: Column, promoted_today: Column, most: int = DAILY_PROMOTIONS) -> Column:
    return tier.isin(1, 2) & (confidence == "high") & (promoted_today < most)


def stuck(beats: DataFrame, as_of: Column, default_interval_s: int = 600) -> DataFrame:
    """Loops whose last sign of life is older than their interval allows."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("beat_at").cast("timestamp"))) / 1e6
    most = F.coalesce(F.col("interval_s") * F.coalesce("multiplier", F.lit(3.0)), F.lit(float(default_interval_s)))
    return beats.select("name", age.alias("age_s"), most.alias("most_s"), (age > most).alias("stuck"))


def http_outcome(status: Column) -> Column:
    return F.when(status.between(200, 299) | (status == 304), "ok").when(status == 429, "wait").when(status == 403, "forbidden").when(status == 404, "not_found").when(status >= 500, "retry").otherwise("returned")


def token_bucket(requests: DataFrame, per_minute: float) -> DataFrame:
    """When each request of a domain is let through: a bucket that fills at per_minute / 60 a second and holds five seconds' worth, at least 1. requests: domain, at (seconds), id.

    Every request waits on the one before, so a domain's requests are one sequence: each task takes whole domains.
    """
    rate = per_minute / 60
    capacity = max(5 * rate, 1.0)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "id"], ignore_index=True)
        level, now, out = capacity, rows["at"].iloc[0] if len(rows) else 0.0, []
        for at in rows["at"]:
            t = max(at, now)
            level = min(capacity, level + (t - now) * rate)
            now = t
            if level < 1:
                now += (1 - level) / rate
                level = 1.0
            level -= 1
            out.append(now)
        return rows.assign(passed_at=out)[["domain", "id", "at", "passed_at"]]

    return requests.select("domain", "id", "at").groupBy("domain").applyInPandas(run, "domain string, id long, at double, passed_at double")


def circuit_breaker(calls: DataFrame, failures: int = 5, open_s: float = 300.0, probe_s: float = 60.0) -> DataFrame:
    """What a breaker does with each call of a domain (domain, id, at, ok): allowed or rejected.

    It opens after so many failures in a row. After open_s it lets one call through as a probe: its success closes the
    breaker, its failure opens it again. A probe whose outcome is not known (ok is null) is waited for: until probe_s have
    passed all calls are rejected, then the next one is the probe. Outside of probes an unknown outcome changes nothing.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["at", "id"], ignore_index=True)
        state, count, since, said = "closed", 0, 0.0, []
        for at, ok in zip(rows["at"], rows["ok"]):
            wait = {"closed": 0.0, "open": open_s, "probing": probe_s}[state]
            if state != "closed" and at - since < wait:
                said.append("rejected")
                continue
            said.append("allowed")
            if state != "closed":
                state, since = "probing", at
            if pd.isna(ok):
                continue
            if ok:
                state, count = "closed", 0
            elif state == "probing":
                state = "open"
            else:
                count += 1
                if count >= failures:
                    state, since = "open", at
        return rows.assign(decision=said)[["domain", "id", "at", "decision"]]

    return calls.select("domain", "id", "at", "ok").groupBy("domain").applyInPandas(run, "domain string, id long, at double, decision string")


def give_up_stream(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """For applyInPandasWithState: the same rule as domain_states, for fetches (domain, ok, http_status, at) that arrive in order."""
    ever, first, refused, given = state.get if state.exists else (False, -1, 0, -1)
    last = -1
    for rows in batches:
        for at, part in rows.assign(at=rows["at"].astype("datetime64[us]").astype("int64")).groupby("at", sort=True):
            last, ok = int(at), bool(part["ok"].any())
            ever = ever or ok
            if ok:
                refused = 0
            else:
                first = int(at) if first < 0 else first
                refused += int((part["http_status"] == 403).sum())
                if not ever and given < 0 and at - first >= GIVE_UP_HOURS * 3_600_000_000:
                    given = int(at)
    state.update((ever, first, refused, given))
    stamp = lambda us: pd.Timestamp(us, unit="us") if us >= 0 else pd.NaT
    yield pd.DataFrame({"domain": [key[0]], "ever_succeeded": [ever], "first_failure_at": [stamp(first)], "consecutive_403_count": [refused], "given_up": [given >= 0], "given_up_at": [stamp(given)], "last_checked_at": [stamp(last)]})
