"""Queries over replayed generation and publishing, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomspan.functions import columns as C
from loomspan.operators import drafts as D, generation as G, quota as Q
from loomspan.plans import catalog as P
from loomspan.session import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


# -- generation: three tries, names that clash, replies that lack items -----------

_INTENTS = ", ".join(f"'{k}'" for k in D.INTENTS)
_TRIED = {1: "'Shared ' || (draft_id % 30)", 2: "'Shared ' || (draft_id % 30) || ' two'", 3: "'Shared ' || (draft_id % 30) || ' two ' || draft_id"}


def _round_sql(k: int) -> str:
    """CTEs f{k} and r{k}: faults and verdicts of the k-th try."""
    left = "" if k == 1 else f"where draft_id in (select draft_id from r{k - 1} where verdict <> 'accepted')"
    known = " union all ".join(f"select nn from r{j} where verdict = 'accepted'" for j in range(1, k)) or "select '' where false"
    start = " + ".join(f"(select cast(ceil(count(*) / 50) as bigint) from r{j})" for j in range(1, k)) or "0"
    return f"""
t{k} as (select * exclude (name), case when draft_id % 10 = 0 then {_TRIED[k]} else name end as name from base),
f{k} as (select draft_id, name, {P._NAME.format('name')} as nn, case when draft_id % {7**k} = 0 then 'missing from response'
  when intent_key is null or intent_key not in ({_INTENTS}) then 'invalid intentKey' when len(list_filter([{P._CHECKS}], lambda r: r is not null)) > 0 then 'schema/field validation failed' end as fault
  from t{k} {left}),
g{k} as (select *, coalesce(fault, case when nn in ({known}) then 'replacement name already exists' end) as reason from f{k}),
r{k} as (select draft_id, name, nn, {k} as try, {start} + (row_number() over (order by draft_id) - 1) // 50 as batch,
  case when reason is not null then reason when row_number() over (partition by nn, reason is null order by draft_id) > 1 then 'replacement name already exists' else 'accepted' end as verdict from g{k})"""


_BASE = "base as (select distinct draft_id, name, category, audience, problem, promise, differentiator, workflow, keywords, metrics, intent_key from catalog_drafts)"
_ROUNDS = f"with {_BASE}, {_round_sql(1)}, {_round_sql(2)}, {_round_sql(3)}"


def _generated(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = P._drafts(spark, d)
    key = F.col("draft_id").cast("string")
    replies = None
    shared = F.concat(F.lit("Shared "), (F.col("draft_id") % 30).cast("string"))
    for k, name in ((1, shared), (2, F.concat(shared, F.lit(" two"))), (3, F.concat(shared, F.lit(" two "), key))):
        tried = rows.filter(F.col("draft_id") % 7**k != 0).withColumn("name", F.when(F.col("draft_id") % 10 == 0, name).otherwise(F.col("name")))
        tried = tried.select(
            key.alias("id"), F.lit(k).alias("try"), F.col("draft_id").alias("pos"), F.struct(*P._ACCEPT, "intent_key").alias("product"), F.lit(False).alias("extra_fields"),
            F.array().cast("array<string>").alias("issues"),
        )
        replies = tried if replies is None else replies.unionByName(tried)
    none = spark.createDataFrame([], "name_normalized string")
    return G.generate(rows.select(key.alias("id"), F.col("draft_id").alias("pos")), replies, none)


@query(_ROUNDS + " select cast(draft_id as varchar) as id, try, cast(batch as bigint) as batch, name from (" + " union all ".join(f"select * from r{k}" for k in (1, 2, 3)) + ") where verdict = 'accepted'")
def q_generation(spark, d):
    """What is saved after at most three tries, with its batch."""
    return _generated(spark, d)[0].select("id", "try", "batch", "product.name")


@query(_ROUNDS + " select cast(draft_id as varchar) as id, verdict from r3 where verdict <> 'accepted'")
def q_unfinished(spark, d):
    """What three tries left unfinished."""
    return _generated(spark, d)[1]


@query("""with q as (select distinct run_id as request, model, outcome from run_items where model is not null),
o as (select request, model, row_number() over (partition by request order by model) as pref, max(case when outcome = 'done' then 1 else 0 end) as fine from q group by request, model),
b as (select request, min(case when fine = 1 then pref end) as p from o group by 1)
select o.request, max(case when pref = p then model end) as model, count(*) filter (fine = 0) as failures from o join b using (request) where p is null or pref <= p group by o.request""")
def q_answered(spark, d):
    """Per run the first model that answered, with the failures before it."""
    from pyspark.sql import Window

    log = table(spark, d, "run_items").filter("model is not null")
    each = log.groupBy(F.col("run_id").alias("request"), "model").agg(F.min(F.when(F.col("outcome") == "done", 200)).alias("status"))
    # A run has a handful of models.
    ranked = each.withColumn("pref", F.row_number().over(Window.partitionBy("request").orderBy("model")))
    return G.answered(ranked.select("request", "model", "pref", F.coalesce("status", F.lit(500)).alias("status")))


@query(f"""with {P._CUR}, e as (select *, (row_number() over (order by ordinal, source_url) - 1) // 50 as cycle, {P._READY} and status <> 'published' as ready, ordinal % 701 <> 700 as fine from cur),
p as (select min(cycle) as last from e where ready and not fine),
s as (select cycle, 1 as step, source_url from e where status <> 'published' and attempts < 3 and (source_content_hash is null or not external_checked)
 union all select cycle, 2, source_url from e where status <> 'published' and draft_name_normalized is not null
 union all select cycle, 3, source_url from e where ready union all select cycle, 4, source_url from e where ready and fine)
select cycle, step, source_url from s, p where last is null or cycle <= last""")
def q_cycles(spark, d):
    """Bounded cycles up to the first that leaves a generation unfinished."""
    items = P._items(spark, d)
    return G.cycles(items, items.filter("ordinal % 701 <> 700").select("source_url"))


@query("""with e as (select run_id, entry_id, row_number() over (partition by run_id order by entry_id) as k, count(*) over (partition by run_id) as n from (select distinct run_id, entry_id from run_items))
select run_id as day, entry_id as pos, cast(case when k <= 3 then 0 when k <= 10 then 1 when k <= 17 then 2 when k <= 21 then 3 when k <= 23 then 4 else 5 end as bigint) as batch,
 cast(12 * least(n, case when k <= 3 then 3 when k <= 10 then 10 when k <= 17 then 17 when k <= 21 then 21 when k <= 23 then 23 else 24 end) as bigint) as used, true as acknowledged from e where k <= 24""")
def q_publish_loop(spark, d):
    """What a budget of 300 rows lets through when a product writes 12; reserved at 100, then at 22."""
    rows = table(spark, d, "run_items").select("run_id", "entry_id").distinct()
    return Q.publish_ledger(rows.select(F.col("run_id").alias("day"), F.col("entry_id").alias("pos"), F.lit(12.0).alias("written")), 300, 7)


@query()
def q_pool(spark, d):
    """Requests over the keys of a pool with one cursor; an event in twenty reports a failure."""
    at = F.col("ts").cast("timestamp")
    failed = F.col("event_id") % 20 == 0
    rows = table(spark, d, "events").select(
        F.lit("p").alias("pool"), F.col("event_type").alias("model"), at.alias("at"), F.abs(F.col("value")).cast("long").alias("tokens"), F.when(failed, F.col("user_id") % 3).alias("failed_key"),
        F.when(failed, 503).alias("status"), F.when(failed, at + F.expr("interval 300 seconds")).alias("until"),
    )
    return Q.pool_ledger(rows, 3, rpd=200, rpm=3)


@query("select source_url as key, max_by(coalesce(content_hash, ''), struct_pack(a := logged_at, b := coalesce(content_hash, ''))) as value from run_items where source_url is not null group by 1")
def q_settings(spark, d):
    """The last value of each key."""
    return G.settings(table(spark, d, "run_items").select(F.col("source_url").alias("key"), F.coalesce("content_hash", F.lit("")).alias("value"), F.col("logged_at").alias("at")))


@query("""with x as (select distinct draft_id, keywords, workflow from catalog_drafts where keywords is not null and workflow is not null)
select draft_id as request, cast(case when len(keywords) = len(workflow) then i end as integer) as pos, case when len(keywords) = len(workflow) then keywords[i + 1] end as sent,
 case when len(keywords) = len(workflow) then workflow[i + 1] end as got
from (select *, unnest(case when len(keywords) = len(workflow) and len(keywords) > 0 then range(len(keywords)) else [0] end) as i from x)""")
def q_zipped(spark, d):
    """Two lists paired by position; unequal ones are an error of the request."""
    rows = P._drafts(spark, d).filter("keywords is not null and workflow is not null").withColumnRenamed("draft_id", "request")
    out = G.zipped(rows.select("request", F.col("keywords").alias("sent")), rows.select("request", F.col("workflow").alias("got")))
    return out


@query("""select batch, list_sort(list_distinct(list(intent_key))) as intents from (select intent_key, (row_number() over (order by draft_id) - 1) // 25 as batch
from (select distinct draft_id, intent_key from catalog_drafts)) where intent_key is not null group by batch""")
def q_batch_intents(spark, d):
    """The sorted distinct intents of each batch of 25 drafts."""
    from loomspan.operators.checkpoint import numbered_groups

    rows = numbered_groups(table(spark, d, "catalog_drafts").select("draft_id", "intent_key").distinct(), ["draft_id"], 25)
    return rows.filter("intent_key is not null").groupBy("batch").agg(F.array_sort(F.collect_set("intent_key")).alias("intents"))


@query("""select draft_id, draft_id % 3 <> 0 or draft_id % 5 = 0 as unfit from (select distinct draft_id from catalog_drafts)""")
def q_field_sets(spark, d):
    """Products whose keys are not exactly the fields; two in three lack the intent, one in five has a field too many."""
    rows = P._drafts(spark, d)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in P._ACCEPT]
    json = F.to_json(F.struct(*fields, F.when(F.col("draft_id") % 3 == 0, "x").alias("intent_key"), F.when(F.col("draft_id") % 5 == 0, "y").alias("note")))
    return rows.select("draft_id", D.extra_or_missing(json).alias("unfit"))


@query("""select event_id, case when event_id % 5 in (0, 1) then value end as number from events""")
def q_finite(spark, d):
    """Usage figures as numbers: no booleans, no strings, no infinities."""
    v = F.format_string("%.10f", F.col("value"))
    text = F.when(F.col("event_id") % 5 <= 1, v).when(F.col("event_id") % 5 == 2, "true").when(F.col("event_id") % 5 == 3, F.concat(F.lit('"'), v, F.lit('"'))).otherwise("1e999")
    return table(spark, d, "events").select("event_id", F.when(C.finite_number(text).isNotNull(), F.col("value")).alias("number"))
