"""Queries over the call and write ledgers; run_items stands for the calls."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from loomspan.functions import columns as C
from loomspan.operators import quota as Q
from loomspan.operators.checkpoint import numbered_groups
from loomspan.session import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = re.sub(r"\bat\b", '"at"', sql)  # a reserved word
        return fn

    return register


def _calls(spark, d) -> DataFrame:
    """event_type as model, two scopes, the value as tokens."""
    at = F.col("ts").cast("timestamp").alias("at")
    scope = F.concat(F.lit("key-"), (F.col("user_id") % 2).cast("string")).alias("scope")
    return table(spark, d, "events").select("event_id", scope, F.col("event_type").alias("model"), at, F.abs(F.col("value")).cast("long").alias("tokens"))


_CALLS = "calls as (select event_id, 'key-' || (user_id % 2) as scope, event_type as model, ts as at, trunc(abs(value))::bigint as tokens from events)"
_DAY = "cast(timezone('America/Los_Angeles', timezone('UTC', {})) as date)"
_NEXT = f"timezone('UTC', timezone('America/Los_Angeles', cast({_DAY} + 1 as timestamp)))"


@query(f"""with {_CALLS} select scope, model, at, tokens, {_DAY.format('at')} as day,
 count(*) over w as recent_calls, (sum(tokens) over w)::bigint as recent_tokens,
 count(*) over (partition by scope, model, {_DAY.format('at')} order by at range unbounded preceding) as calls_today,
 (max(at) over w) + interval 61 second as release_at
from calls window w as (partition by scope, model order by epoch_us(at) range between 3599999999 preceding and current row)""")
def q_rpm_tpm_window(spark, d):
    out = Q.call_windows(_calls(spark, d), seconds=3600)
    return out.select("scope", "model", F.col("at").cast("timestamp_ntz").alias("at"), "tokens", "day", "recent_calls", "recent_tokens", "calls_today", F.col("release_at").cast("timestamp_ntz").alias("release_at"))


@query(f"""with {_CALLS} select scope, model, at, tokens, count(*) over w as recent_calls, (sum(tokens) over w)::bigint as recent_tokens
from calls window w as (partition by scope, model order by epoch_us(at) range between 59999999 preceding and current row)""")
def q_minute_window(spark, d):
    """Calls and tokens of the last 60 seconds."""
    out = Q.call_windows(_calls(spark, d))
    return out.select("scope", "model", F.col("at").cast("timestamp_ntz").alias("at"), "tokens", "recent_calls", "recent_tokens")


@query(f"with {_CALLS} select scope, model, {_DAY.format('at')} as day, count(*) as calls from calls group by all")
def q_daily_calls(spark, d):
    return _calls(spark, d).groupBy("scope", "model", C.pacific_day(F.col("at")).alias("day")).agg(F.count("*").alias("calls"))


@query(f"with {_CALLS} select event_id, {_NEXT.format('at')} as resets_at from calls")
def q_next_reset(spark, d):
    return _calls(spark, d).select("event_id", C.next_pacific_day(F.col("at")).cast("timestamp_ntz").alias("resets_at"))


def _errors(spark, d) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    at = F.col("ts").cast("timestamp").alias("at")
    status = F.element_at(F.array(*[F.lit(x) for x in (429, 429, 503, None, 400, 401, 500)]), (k % 7) + 1).alias("status")
    body = F.when(k % 14 == 0, "RequestsPerDay").otherwise("busy").alias("body")
    return table(spark, d, "events").select(F.lit("s").alias("scope"), F.col("event_type").alias("model"), at, status, body, (k % 400).cast("double").alias("wait"))


_ERRORS = """errs as (select 's' as scope, event_type as model, ts as at, [429, 429, 503, null, 400, 401, 500][(k % 7) + 1] as status,
 case when k % 14 = 0 then 'RequestsPerDay' else 'busy' end as body, (k % 400)::double as wait from (select *, (props->>'$.k')::int as k from events))"""
_KIND = """case when status is null then 'transport_failure' when status = 429 and regexp_matches(lower(body), 'perday|per_day|per day|daily') then 'daily_quota_429'
 when status = 429 then 'quota_429_unspecified' when status = 503 then 'service_unavailable_503' else 'http_' || status end"""


@query(f"with {_ERRORS} select scope, model, {_KIND} as kind, count(*) as n from errs group by all")
def q_outcomes(spark, d):
    return _errors(spark, d).groupBy("scope", "model", C.outcome_kind(F.col("status"), F.col("body")).alias("kind")).agg(F.count("*").alias("n"))


_NOW = "timestamp '2024-01-20 12:00:00'"


@query(f"""with {_CALLS}, e as (select 'key-' || (user_id % 2) as scope, event_type as model, ts as at, (props->>'$.k')::int as k from events),
b as (select scope, model, max(at + interval 1 hour) as until from e where k % 9 = 0 group by all),
t as (select scope, model, count(*) as n from calls where {_DAY.format('at')} = {_DAY.format(_NOW)} group by all),
f as (select scope, model, count(*) as n from e where at >= {_NEXT.format(_NOW)} - interval 1 day and k % 4 = 0 group by all),
m as (select distinct scope, model from calls)
select m.scope, m.model, coalesce(t.n, 0) as calls_today, greatest(0, 20 - coalesce(t.n, 0)) as "left", coalesce(f.n, 0) as failures,
 case when coalesce(t.n, 0) >= 20 then greatest(greatest({_NOW}, coalesce(until, {_NOW})), {_NEXT.format(_NOW)}) else greatest({_NOW}, coalesce(until, {_NOW})) end as ready_at
from m left join t on t.scope = m.scope and t.model = m.model left join f on f.scope = m.scope and f.model = m.model left join b on b.scope = m.scope and b.model = m.model""")
def q_day_report(spark, d):
    """Use, failures and readiness of each model at one moment."""
    k = F.get_json_object("props", "$.k").cast("int")
    scope = F.concat(F.lit("key-"), (F.col("user_id") % 2).cast("string")).alias("scope")
    logged = table(spark, d, "events").select(scope, F.col("event_type").alias("model"), F.col("ts").cast("timestamp").alias("at"), k.alias("k"))
    blocks = logged.filter("k % 9 = 0").groupBy("scope", "model").agg(F.max(F.col("at") + F.expr("interval 1 hour")).alias("until"))
    outcomes = logged.withColumn("kind", F.when(F.col("k") % 4 == 0, "http_500").otherwise("http_success"))
    out = Q.day_report(_calls(spark, d), outcomes, blocks, F.lit("2024-01-20 12:00:00").cast("timestamp"))
    return out.withColumn("ready_at", F.col("ready_at").cast("timestamp_ntz"))


@query(f"""with {_ERRORS} select scope, model, max(case when status in (400, 404) then at + interval 1 day when status in (401, 403) then at + interval 1 hour
 when status = 503 then at + to_milliseconds((greatest(300, wait) * 1000)::bigint) when {_KIND} = 'daily_quota_429' then {_NEXT.format('at')}
 else at + to_milliseconds((greatest(65, wait) * 1000)::bigint) end) as until from errs group by all""")
def q_cooldowns(spark, d):
    return Q.cooldowns(_errors(spark, d)).select("scope", "model", F.col("until").cast("timestamp_ntz").alias("until"))


@query(f"""with {_ERRORS} select at, case when regexp_matches(lower(body), 'daily|per day') then cast(cast(at as date) + 1 as timestamp) else at + to_milliseconds((greatest(60, wait) * 1000)::bigint) end as until
from errs where status = 429""")
def q_catalog_cooldown(spark, d):
    rows = _errors(spark, d).filter("status = 429")
    return rows.select(F.col("at").cast("timestamp_ntz").alias("at"), C.catalog_cooldown_until(F.col("at"), F.col("body"), F.col("wait")).cast("timestamp_ntz").alias("until"))


@query()
def q_admission(spark, d):
    """Requests admitted one after the other; see the test against a plain loop."""
    return Q.admit(_calls(spark, d), rpd=200, rpm=3, tpm=25_000)


@query(f"""with {_CALLS}, r as (select scope, model, max(at) as ready_at, case model when 'click' then 1 when 'view' then 2 else 3 end as pref from calls group by all)
select scope, arg_min(model, (pref, model)) filter (ready_at <= timestamp '2024-01-30') as model, min(ready_at) as next_ready from r group by scope""")
def q_model_pick(spark, d):
    pref = F.when(F.col("model") == "click", 1).when(F.col("model") == "view", 2).otherwise(3)
    ready = _calls(spark, d).groupBy("scope", "model").agg(F.max("at").alias("ready_at")).withColumn("pref", F.struct(pref, F.col("model")))
    out = Q.pick_model(ready, F.lit("2024-01-30").cast("timestamp"))
    return out.select("scope", "model", F.col("next_ready").cast("timestamp_ntz").alias("next_ready"))


@query("""select event_id as request, arg_min(key, ((key - cursor) % 5 + 5) % 5) as key from (select event_id, event_id % 5 as cursor, unnest([0, 1, 2, 3, 4]) as key, user_id from events) where (user_id + key) % 3 <> 0 group by 1""")
def q_key_rotation(spark, d):
    rows = table(spark, d, "events").select(F.col("event_id").alias("request"), (F.col("event_id") % 5).alias("cursor"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("key"), "user_id")
    return Q.rotate_keys(rows.filter((F.col("user_id") + F.col("key")) % 3 != 0), 5).select("request", F.col("key").cast("int").alias("key"))


@query("""select run_id, entry_id, cost, (sum(cost) over w)::bigint as spent, sum(cost) over w <= 300 as fits from (select distinct run_id, entry_id, 8 + entry_id % 5 as cost from run_items)
window w as (partition by run_id order by entry_id rows unbounded preceding)""")
def q_budget_fit(spark, d):
    rows = table(spark, d, "run_items").select("run_id", "entry_id", (8 + F.col("entry_id") % 5).alias("cost")).distinct()
    return Q.fits_budget(rows, "run_id", "entry_id", "cost", 300)


@query("select run_id, greatest(8, cast(ceil(count(*) / 7.0 * 1.5) as bigint) + 4) as estimate, greatest(0, cast(floor((80000 - count(*)) / ceil(count(*) / 7.0)) as bigint)) as capacity from (select distinct run_id, entry_id from run_items) group by 1")
def q_write_estimates(spark, d):
    rows = table(spark, d, "run_items").select("run_id", "entry_id").distinct().groupBy("run_id").agg(F.count("*").alias("n"))
    return rows.select("run_id", C.write_estimate(F.col("n"), F.lit(7.0)).alias("estimate"), C.write_capacity(F.lit(80000), F.col("n"), F.col("n") / 7.0).alias("capacity"))


@query("""select draft_id, ordinal, cast(floor(ordinal / 25) as bigint) as batch from (select draft_id, row_number() over (order by draft_id) - 1 as ordinal from (select distinct draft_id from catalog_drafts))""")
def q_batches(spark, d):
    return numbered_groups(table(spark, d, "catalog_drafts").select("draft_id").distinct(), ["draft_id"], 25).select("draft_id", "ordinal", "batch")


@query()
def s_quota_stream(spark, d):
    """Admission as a stream over the events."""
    from loomspan.streaming.admission import admit_stream, drain

    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(d)
    calls = stream.select(F.lit("s").alias("scope"), F.col("event_type").alias("model"), F.col("ts").cast("timestamp").alias("at"), F.abs(F.col("value")).cast("long").alias("tokens"))
    return drain(admit_stream(calls, 200, 3, 25_000), "quota-stream")


@query("""select source_url, status, attempts from (select *, row_number() over (partition by source_url order by updated_at desc, status desc, attempts desc) as n from work_items where source_url is not null) where n = 1""")
def s_upsert_stream(spark, d):
    """Snapshots folded into a versioned table as a stream."""
    from loomspan.streaming.admission import upsert_stream

    schema = table(spark, d, "work_items").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/work_items.parquet*").select("source_url", "status", "attempts", "updated_at")
    return upsert_stream(stream, "source_url", ["status", "attempts"], "updated_at", "upsert-stream").select("source_url", "status", "attempts")
