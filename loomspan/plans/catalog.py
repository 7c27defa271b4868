"""Queries over the catalog tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomspan.functions import columns as C
from loomspan.operators import checkpoint as K, drafts as D
from loomspan.operators.generation import acknowledged
from loomspan.operators.positions import ordinals
from loomspan.sources import web as W
from loomspan.session import table

QUERIES = {}
ORACLE: dict[str, str] = {}
CREATED = "2025-06-01T00:00:00Z"


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def _items(spark, d) -> DataFrame:
    return K.current_items(table(spark, d, "work_items"))


def _unique(spark, d, name: str, key: str, stamp: str) -> DataFrame:
    rows = table(spark, d, name)
    rest = [c for c in rows.columns if c not in (key, stamp)]
    return rows.groupBy(key).agg(F.max(F.struct(stamp, *rest)).alias("m")).select(key, "m.*")


def _drafts(spark, d) -> DataFrame:
    return _unique(spark, d, "catalog_drafts", "draft_id", "created_at")


def _products(spark, d) -> DataFrame:
    return _unique(spark, d, "source_products", "record_id", "loaded_at")


# -- text and URLs -------------------------------------------------------------

_WS = r"'[\s\x0b\x1c-\x1f\x{{85}}\pZ]+', ' ', 'g'"
_COLLAPSE = f"trim(regexp_replace({{}}, {_WS}))"
_FOLD = "array_to_string(regexp_extract_all(strip_accents(lower(replace(replace({}, 'ª', 'a'), 'º', 'o'))), '[a-z0-9]+'), ' ')"
_NAME = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_BRAND = r"trim(split_part(regexp_replace({}, '\s*[:|]\s*|\s+[–—]\s+|\s+-\s+', chr(1)), chr(1), 1))"


@query(f"""select distinct page_id, rtrim(left({_COLLAPSE.format('title')}, 300)) as title, rtrim(left({_COLLAPSE.format('description')}, 1500)) as description
from external_pages""")
def q_collapse_text(spark, d):
    pages = table(spark, d, "external_pages")
    return pages.select("page_id", C.collapse(F.col("title"), 300).alias("title"), C.collapse(F.col("description"), 1500).alias("description")).distinct()


@query(f"select distinct record_id, {_FOLD.format('tagline')} as normal, replace({_FOLD.format('source_name')}, ' ', '') as name_key from source_products")
def q_normalize_text(spark, d):
    rows = table(spark, d, "source_products")
    return rows.select("record_id", C.normalize_text(F.col("tagline")).alias("normal"), C.name_key(F.col("source_name")).alias("name_key")).distinct()


@query(f"select distinct draft_id, {_NAME.format('name')} as name_normalized from catalog_drafts")
def q_normalized_name(spark, d):
    return table(spark, d, "catalog_drafts").select("draft_id", C.normalized_name(F.col("name")).alias("name_normalized")).distinct()


_GENERIC = ", ".join(f"'{w}'" for w in dict.fromkeys(C.GENERIC_NAME_WORDS))
_TITLED = "source_name || ': ' || coalesce(tagline, '')"


@query(f"""select record_id, brand, list_filter(string_split({_FOLD.format('brand')}, ' '), lambda t: len(t) >= 4 and t not in ({_GENERIC})) as tokens
from (select distinct record_id, {_BRAND.format(_TITLED)} as brand from source_products)""")
def q_brand_tokens(spark, d):
    titled = F.concat("source_name", F.lit(": "), F.coalesce("tagline", F.lit("")))
    rows = table(spark, d, "source_products").select("record_id", C.brand_identity(titled).alias("brand")).distinct()
    return rows.select("record_id", "brand", C.distinctive_tokens(C.normalize_text(F.col("brand"))).alias("tokens"))


_KEYS = ", ".join(f"'{k}'" for k in C.TRACKING_KEYS)
_PARTS = r"'^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$'"


@query(f"""select record_id, origin || case when path = '' then '/' else path end || case when q = '' then '' else '?' || q end as url from (
select record_id, lower(regexp_extract(u, {_PARTS}, 1)) as origin, regexp_extract(u, {_PARTS}, 2) as path,
 array_to_string(list_transform(list_filter(string_split(regexp_extract(u, {_PARTS}, 3), '&'),
   lambda x: x <> '' and lower(split_part(x, '=', 1)) not in ({_KEYS}) and not starts_with(lower(split_part(x, '=', 1)), 'utm_')),
   lambda x: case when contains(x, '=') then x else x || '=' end), '&') as q
from (select distinct record_id, website_url as u from source_products where website_url is not null))""")
def q_clean_url(spark, d):
    rows = table(spark, d, "source_products").filter("website_url is not null").select("record_id", "website_url").distinct()
    return rows.select("record_id", C.clean_url(F.col("website_url")).alias("url"))


_SITE = r"'^https?://(?:www\.)?launchboard\.example/products/([a-z0-9]+(?:-[a-z0-9]+)*)/?(?:[?#].*)?$'"
_ENTRIES = f"""select entry_no as position, 'https://www.launchboard.example/products/' || s as url, m as last_modified from (
  select entry_no, regexp_extract({_COLLAPSE.format('url')}, {_SITE}, 1) as s, nullif({_COLLAPSE.format('last_modified')}, '') as m from sitemap_entries) where s <> ''"""


@query(_ENTRIES)
def q_sitemap_entries(spark, d):
    return W.sitemap_entries(table(spark, d, "sitemap_entries"))


@query(f"select position, url, last_modified, regexp_extract(url, '([^/]*)/*$', 1) as external_id from ({_ENTRIES})")
def q_url_tail(spark, d):
    return q_sitemap_entries(spark, d).withColumn("external_id", C.url_tail(F.col("url")))


@query(f"select url, min(position) as position, arg_max(coalesce(last_modified, '~'), position) as last_modified from ({_ENTRIES}) group by url")
def q_dedupe_last_value(spark, d):
    rows = q_sitemap_entries(spark, d).withColumn("last_modified", F.coalesce("last_modified", F.lit("~")))
    return W.first_position_last_value(rows)


_ISO_SQL = r"'^\d{{4}}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d{{1,6}})?)?(?:Z|[+-]\d\d:?\d\d)?)?$'"
_EPOCH = f"coalesce(epoch(case when regexp_matches({{0}}, {_ISO_SQL}) then try_cast({{0}} as timestamptz) end), 0.0)"


@query(f"""select url, position from (select url, min(position) as position, arg_max(coalesce(last_modified, '~'), position) as m from ({_ENTRIES}) group by url)
order by {_EPOCH.format('m')} desc, position limit 100 offset 20""")
def q_newest_slice(spark, d):
    rows = q_dedupe_last_value(spark, d)
    return rows.orderBy(F.desc(C.modified_at(F.col("last_modified"))), "position").offset(20).limit(100).select("url", "position")


@query("""select source_url, regexp_matches(website_url, '^https://[^/?#@]+/?$') as origin, starts_with(website_url, 'https://') as plain
from (select distinct source_url, website_url from source_products where website_url is not null)""")
def q_url_guards(spark, d):
    rows = table(spark, d, "source_products").filter("website_url is not null").select("source_url", "website_url").distinct()
    refusal = C.url_refusal(F.col("website_url"))
    return rows.select("source_url", C.https_origin(F.col("website_url")).alias("origin"), (refusal.isNull() & F.startswith("website_url", F.lit("https://"))).alias("plain"))


# -- selection and state -------------------------------------------------------

_CUR = """cur as (select * exclude (n) from (select *, row_number() over (partition by source_url order by updated_at desc nulls last) as n
  from (select distinct * from work_items where source_url is not null)) where n = 1)"""
_READY = "source_content_hash is not null and external_checked and draft_name_normalized is null and attempts < 3"


@query(f"with {_CUR} select source_url, ordinal from cur where status <> 'published' and draft_name_normalized is not null")
def q_stage_publish(spark, d):
    return K.stage_entries(_items(spark, d), "publish").select("source_url", "ordinal")


@query(f"with {_CUR} select source_url, ordinal from cur where status <> 'published' and {_READY}")
def q_stage_generate(spark, d):
    return K.stage_entries(_items(spark, d), "generate").select("source_url", "ordinal")


@query(f"with {_CUR} select source_url, ordinal from cur where status <> 'published' and (draft_name_normalized is not null or ({_READY}))")
def q_stage_all(spark, d):
    return K.stage_entries(_items(spark, d), "all").select("source_url", "ordinal")


@query(f"""with {_CUR} select source_url, needs from (select *, case when source_content_hash is null then 'source' when not external_checked then 'external' end as needs
from cur where status <> 'published' and attempts < 3) where needs is not null""")
def q_stage_scrape(spark, d):
    return K.scrape_entries(_items(spark, d)).select("source_url", "needs")


@query(f"with {_CUR} select source_url from cur where status <> 'published' and attempts < 3 order by ordinal, source_url limit 200")
def q_pending(spark, d):
    return K.pending(_items(spark, d), limit=200).select("source_url")


@query(f"with {_CUR} select coalesce(status, 'total') as status, count(*) as n from cur group by rollup(status)")
def q_status_rollup(spark, d):
    return K.status_counts(_items(spark, d))


@query(f"""with {_CUR} select source_url, case when status <> 'failed' then status when draft_name_normalized is not null then 'transformed'
 when source_content_hash is not null then 'scraped' else 'queued' end as status, case when status = 'failed' then 0 else attempts end as attempts,
 case when status <> 'failed' then failed_stage end as failed_stage, case when status <> 'failed' then error end as error from cur""")
def q_reset_failures(spark, d):
    return K.reset_failures(_items(spark, d))


@query(f"""with {_CUR}, e as (select url, position, m, row_number() over (order by position) - 1 as ordinal from (
  select url, min(position) as position, arg_max(coalesce(last_modified, '~'), position) as m from ({_ENTRIES}) group by url))
select coalesce(c.source_url, e.url) as source_url, coalesce(c.external_id, regexp_extract(e.url, '([^/]*)/*$', 1)) as external_id,
 case when e.url is not null then nullif(e.m, '~') else c.last_modified end as last_modified,
 cast(case when e.url is not null then e.ordinal else c.ordinal end as bigint) as ordinal, coalesce(c.status, 'queued') as status, c.source_url is null as added
from cur c full join e on e.url = c.source_url""")
def q_enqueue_upsert(spark, d):
    entries = ordinals(q_dedupe_last_value(spark, d), ["position"]).withColumn("last_modified", F.nullif("last_modified", F.lit("~")))
    return K.enqueue(_items(spark, d), entries)


@query(f"""with {_CUR}, o as (select url, min(position) as position from ({_ENTRIES}) group by url),
e as (select url from o union select replace(url, 'https://www.', 'https://' || h || '.') from o, (select unnest(['old', 'new']) as h) where position % 50 = 0), n as (select c.external_id, c.source_url from cur c union select regexp_extract(url, '([^/]*)/*$', 1), url from e where url not in (select source_url from cur))
select external_id, count(*) as urls from n group by 1 having count(*) > 1""")
def q_enqueue_clashes(spark, d):
    """Identities that several URLs claim; one entry in fifty is planted under two other hosts."""
    entries = q_dedupe_last_value(spark, d)
    planted = entries.filter("position % 50 = 0").withColumn("h", F.explode(F.array(F.lit("https://old."), F.lit("https://new."))))
    planted = planted.withColumn("url", F.replace("url", F.lit("https://www."), F.col("h"))).drop("h")
    entries = entries.unionByName(planted)
    return K.enqueue_clashes(_items(spark, d), entries)


@query(f"""with {_CUR}, x as (select source_url, max(name) as name, max(generation_model) as model from catalog_drafts group by 1)
select c.source_url, case when x.source_url is null then status else 'transformed' end as status, case when x.source_url is null then draft_name_normalized else {_NAME.format('x.name')} end as draft_name_normalized,
 case when x.source_url is null then c.generation_model else x.model end as generation_model, case when x.source_url is null then failed_stage end as failed_stage from cur c left join x using (source_url)""")
def q_mark_transformed(spark, d):
    new = table(spark, d, "catalog_drafts").groupBy("source_url").agg(F.max("name").alias("name"), F.max("generation_model").alias("model")).withColumn("hash", F.lit("h"))
    return K.mark(_items(spark, d), new, "transformed").select("source_url", "status", "draft_name_normalized", "generation_model", "failed_stage")


@query(f"""with {_CUR}, p as (select distinct source_url from source_products), e as (select distinct source_url from external_pages), d as (select source_url, 'p-' || max(draft_id) as slug from catalog_drafts group by 1)
select c.source_url, case when d.slug is not null then 'published' when p.source_url is not null then 'scraped' else status end as status, external_checked or e.source_url is not null as external_checked,
 coalesce(d.slug, published_slug) as published_slug, case when d.slug is null and p.source_url is null then error end as error
from cur c left join p using (source_url) left join e using (source_url) left join d using (source_url)""")
def q_mark_stages(spark, d):
    """Scraped, then checked, then published, each over what the stage has finished."""
    urls = lambda name: table(spark, d, name).select("source_url").distinct()
    slugs = table(spark, d, "catalog_drafts").groupBy("source_url").agg(F.concat(F.lit("p-"), F.max("draft_id").cast("string")).alias("slug"))
    out = K.mark(K.mark(_items(spark, d), urls("source_products"), "scraped"), urls("external_pages"), "external")
    return K.mark(out, slugs, "published").select("source_url", "status", "external_checked", "published_slug", "error")


_LATEST = """upd as (select source_url, outcome, model, content_hash from (select *, row_number() over (partition by source_url order by logged_at desc, entry_id desc) as n
  from (select distinct * from run_items where source_url is not null)) where n = 1)"""


@query(f"""with {_CUR}, {_LATEST} select c.source_url, case outcome when 'done' then 'transformed' when 'failed' then 'failed' else status end as status,
 case when outcome = 'failed' then attempts + 1 else attempts end as attempts, case when outcome = 'done' then coalesce(model, generation_model) else generation_model end as generation_model,
 case when outcome = 'done' then content_hash else source_content_hash end as source_content_hash,
 case when outcome = 'done' then null when outcome = 'failed' then 'transform' else failed_stage end as failed_stage from cur c left join upd u using (source_url)""")
def q_overlay_update(spark, d):
    log = table(spark, d, "run_items").filter("source_url is not null")
    last = F.max(F.struct("logged_at", "entry_id", "outcome", "model", "content_hash")).alias("m")
    return K.overlay(_items(spark, d), log.groupBy("source_url").agg(last).select("source_url", "m.outcome", "m.model", "m.content_hash"))


@query(f"""with n as (select distinct draft_id, name from catalog_drafts union all select distinct -draft_id, upper(name) || '!' from catalog_drafts where draft_id % 20 = 0),
x as (select draft_id, name, {_NAME.format('name')} as name_normalized from n where name is not null),
c as (select name_normalized, count(*) as rows from x group by 1 having count(*) > 1) select draft_id, name, name_normalized, rows from x join c using (name_normalized)""")
def q_name_collision(spark, d):
    """Names that clash but for case and signs; one in twenty is planted."""
    rows = table(spark, d, "catalog_drafts").select("draft_id", "name").distinct()
    planted = rows.filter("draft_id % 20 = 0").select((-F.col("draft_id")).alias("draft_id"), F.concat(F.upper("name"), F.lit("!")).alias("name"))
    return K.name_collisions(rows.unionByName(planted), "draft_id", "name")


_BLOCKED = f"""blk as (select distinct k as name_key from (
 select replace({_FOLD.format("regexp_extract(source_url, '([^/]*)/*$', 1)")}, ' ', '') as k from work_items where source_url is not null
 union all select replace({_FOLD.format(_BRAND.format('source_name'))}, ' ', '') from source_products
 union all select 'alphasentinel' union all select 'skillforge') where k is not null and k <> '')"""


@query(f"with {_BLOCKED} select name_key from blk")
def q_blocked_names(spark, d):
    return K.blocked_names(_items(spark, d), table(spark, d, "source_products"))


@query(f"""with {_BLOCKED}, n as (select draft_id, name from catalog_drafts union select -record_id, source_name from source_products)
select draft_id, name from n where replace({_FOLD.format('name')}, ' ', '') in (select name_key from blk)""")
def q_blocked_semi(spark, d):
    """Names of drafts and, as planted hits, of the products themselves."""
    rows = table(spark, d, "catalog_drafts").select("draft_id", "name")
    rows = rows.union(table(spark, d, "source_products").select(-F.col("record_id"), "source_name")).distinct().withColumn("name_key", C.name_key(F.col("name")))
    return rows.join(q_blocked_names(spark, d), "name_key", "left_semi").select("draft_id", "name")


# -- drafts --------------------------------------------------------------------


def _sized(field, low, high):
    size = f"len({_COLLAPSE.format(field)})"
    return f"case when {field} is null or {size} < {low} or {size} > {high} then '{field} must contain {low}-{high} characters' end"


def _listed(field, least, most, low, high):
    entry = f"len({_COLLAPSE.format('x')})"
    bad = f"len(list_filter({field}, lambda x: x is null or {entry} < {low} or {entry} > {high})) > 0"
    return (
        f"case when {field} is null or len({field}) not between {least} and {most} then '{field} must contain {least}-{most} strings' "
        f"when {bad} then '{field} entries must contain {low}-{high} characters' end"
    )


_CHECKS = ", ".join([_sized(f, *x) for f, x in D.TEXT_LIMITS.items()] + [_listed(f, *x) for f, x in D.LIST_LIMITS.items()])


@query(f"select distinct draft_id, list_filter([{_CHECKS}], lambda r: r is not null) as reasons from catalog_drafts")
def q_draft_validate(spark, d):
    return _drafts(spark, d).select("draft_id", D.rejections().alias("reasons"))


_PUBLIC = "array_to_string(list_transform([name, category, audience, problem, promise, differentiator] || workflow || keywords || metrics, lambda x: coalesce(x, '')), ' ')"


def _screened(spark, d) -> DataFrame:
    """Each draft with its product and page; the greatest record and page stand for repeated ones."""
    drafts = _drafts(spark, d).select("draft_id", "source_url", "name", D.public_text().alias("public_text"))
    product = table(spark, d, "source_products").groupBy("source_url").agg(F.max(F.struct("record_id", "source_name", "tagline", "description")).alias("p"))
    page = table(spark, d, "external_pages").groupBy("source_url").agg(F.max(F.struct("page_id", "title", "description", "text", "skipped_reason")).alias("e"))
    joined = drafts.join(product, "source_url").join(page, "source_url", "left")
    text = D.source_text(F.col("p.tagline"), F.col("p.description"), [F.col("e.title"), F.col("e.description"), F.col("e.text")], F.col("e.skipped_reason"))
    return joined.select("draft_id", "name", "public_text", F.col("p.source_name").alias("source_name"), text.alias("source_text"))


_PAIRS = f"""dr as (select distinct draft_id, source_url, name, {_PUBLIC} as public_text from catalog_drafts),
pr as (select source_url, arg_max(coalesce(source_name, ''), record_id) as source_name, arg_max(coalesce(tagline, ''), record_id) as tagline, arg_max(coalesce(description, ''), record_id) as description from source_products group by 1),
pg as (select source_url, arg_max(case when skipped_reason is null then array_to_string(list_filter([title, description, text], lambda x: x is not null and x <> ''), ' ') else '' end, page_id) as page from external_pages group by 1),
jn as (select draft_id, name, public_text, source_name, array_to_string(list_filter([tagline, pr.description, page], lambda x: x is not null and x <> ''), ' ') as source_text
  from dr join pr using (source_url) left join pg using (source_url))"""
_GRAMS = "case when len({0}) >= 7 then list_transform(range(1, len({0}) - 5), lambda i: array_to_string({0}[i:i+6], ' ')) else [] end"


@query(f"""with {_PAIRS}, v as (select draft_id, regexp_extract_all(strip_accents(lower(public_text)), '[a-z0-9]+') as a, regexp_extract_all(strip_accents(lower(source_text)), '[a-z0-9]+') as b from jn),
w as (select draft_id, case when draft_id % 25 = 0 and len(b) >= 50 then coalesce(a, []) || b[11:40] else a end as a, b from v)
select draft_id from w where list_has_any({_GRAMS.format('a')}, {_GRAMS.format('b')})""")
def q_ngram_overlap(spark, d):
    """Drafts that copy seven words; one in twenty-five with a longer source gets thirty words of it."""
    rows = _screened(spark, d).select("draft_id", C.normalize_text(F.col("public_text")).alias("p"), C.normalize_text(F.col("source_text")).alias("s"))
    copied = F.concat_ws(" ", "p", F.array_join(F.slice(F.split("s", " "), 11, 30), " "))
    rows = rows.withColumn("p", F.when((F.col("draft_id") % 25 == 0) & (F.size(F.split("s", " ")) >= 50), copied).otherwise(F.col("p")))
    return rows.filter(F.arrays_overlap(C.word_ngrams(F.col("p"), 7), C.word_ngrams(F.col("s"), 7))).select("draft_id")


_COMPACT = "replace({}, ' ', '')"
_BI = "case when len({0}) >= 2 then list_distinct(list_transform(range(1, len({0})), lambda i: substr({0}, i, 2))) when len({0}) = 1 then [{0}] else [] end"


@query(f"""with {_PAIRS}, k as (select draft_id, {_COMPACT.format(_FOLD.format(_BRAND.format('source_name')))} as a, {_COMPACT.format(_FOLD.format('name'))} as b from jn),
g as (select draft_id, {_BI.format('a')} as a, {_BI.format('b')} as b from k)
select draft_id, case when len(a) > 0 and len(b) > 0 then 2 * len(list_intersect(a, b)) / (len(a) + len(b)) else 0.0 end as dice from g""")
def q_dice_pairs(spark, d):
    drafts = table(spark, d, "catalog_drafts").select("draft_id", "source_url", "name").distinct()
    product = table(spark, d, "source_products").groupBy("source_url").agg(F.max(F.struct("record_id", "source_name")).getField("source_name").alias("source_name"))
    keys = drafts.join(product, "source_url").select("draft_id", C.name_key(C.brand_identity(F.col("source_name"))).alias("a"), C.name_key(F.col("name")).alias("b"))
    return keys.select("draft_id", C.dice(C.bigrams(F.col("a")), C.bigrams(F.col("b"))).alias("dice"))


_ISSUES = f"""{_PAIRS}, nm as (select draft_id, name, {_FOLD.format(_BRAND.format('source_name'))} as brand, {_FOLD.format('public_text')} as pub,
  regexp_extract_all(strip_accents(lower(source_text)), '[a-z0-9]+') as sw, {_COMPACT.format(_FOLD.format('name'))} as key from jn),
g as (select *, string_split(pub, ' ') as pw, {_COMPACT.format('brand')} as bk from nm),
h as (select *, {_BI.format('bk')} as ga, {_BI.format('key')} as gb from g),
iss as (select draft_id, name, key, list_filter([case when len(brand) >= 3 and len(list_filter(string_split(brand, ' '), lambda t: t <> '' and t not in ({_GENERIC}))) > 0
    and contains(' ' || pub || ' ', ' ' || brand || ' ') then 'source brand appears in public copy' end]
  || list_transform(list_filter(string_split(brand, ' '), lambda t: len(t) >= 4 and t not in ({_GENERIC}) and list_contains(pw, t)), lambda t: 'source brand token appears in public copy: ' || t)
  || [case when len(ga) > 0 and len(gb) > 0 and 2 * len(list_intersect(ga, gb)) / (len(ga) + len(gb)) >= 0.62 then 'replacement name is too similar to source name' end,
      case when list_has_any({_GRAMS.format('pw')}, {_GRAMS.format('sw')}) then 'public copy contains a seven-word source phrase' end], lambda x: x is not null) as issues from h)"""


@query(f"with {_ISSUES} select draft_id, array_to_string(issues, '; ') as issues from iss")
def q_issues_ladder(spark, d):
    return D.screen(_screened(spark, d)).select("draft_id", F.array_join("issues", "; ").alias("issues"))


def _flagged(spark, d) -> DataFrame:
    screened = D.screen(_screened(spark, d))
    blocked = q_blocked_names(spark, d).withColumn("blocked", F.lit(True))
    joined = screened.join(blocked, screened["_key"] == blocked["name_key"], "left")
    own = F.when(F.col("blocked"), F.array(F.lit("replacement name matches a known source or blocked product"))).otherwise(F.array().cast("array<string>"))
    return joined.select("draft_id", "name", F.concat("issues", own).alias("issues")).filter("size(issues) > 0")


@query(f"""with {_BLOCKED}, {_ISSUES} select draft_id, name, array_to_string(all_issues, '; ') as issues from (select draft_id, name,
 issues || case when key in (select name_key from blk) then ['replacement name matches a known source or blocked product'] else [] end as all_issues from iss) where len(all_issues) > 0""")
def q_audit_flagged(spark, d):
    return _flagged(spark, d).select("draft_id", "name", F.array_join("issues", "; ").alias("issues"))


@query(f"""with {_CUR}, {_BLOCKED}, {_ISSUES}, f as (select distinct source_url from catalog_drafts join iss using (draft_id) where len(issues) > 0 or key in (select name_key from blk))
select c.source_url, case when f.source_url is not null then 'scraped' else status end as status, case when f.source_url is not null then 0 else attempts end as attempts,
 case when f.source_url is null then draft_name_normalized end as draft_name_normalized, case when f.source_url is null then generation_model end as generation_model,
 case when f.source_url is null then source_content_hash end as source_content_hash, case when f.source_url is null then failed_stage end as failed_stage, published_slug
from cur c left join f using (source_url)""")
def q_repair(spark, d):
    flagged = table(spark, d, "catalog_drafts").join(_flagged(spark, d).select("draft_id"), "draft_id").select("source_url")
    return K.repaired(_items(spark, d), flagged)


@query(f"""with s as (select distinct record_id, source_url, to_json({{'categories': coalesce(categories, []), 'description': coalesce(description, ''), 'external_id': external_id, 'last_modified': last_modified,
  'source_name': source_name, 'source_url': source_url, 'tagline': coalesce(tagline, ''), 'website_url': website_url}})::varchar as js from source_products),
g as (select source_url, max(struct_pack(i := page_id, d := coalesce(description, ''), u := final_url, r := skipped_reason, t := coalesce(title, ''))) as m from external_pages group by 1),
p as (select source_url, to_json({{'description': m.d, 'final_url': m.u, 'skipped_reason': m.r, 'title': m.t}})::varchar as jp from g)
select record_id, sha256('{{"external_page":' || coalesce(jp, 'null') || ',"source":' || js || '}}') as hash from s left join p using (source_url)""")
def q_content_hash(spark, d):
    """The hash of a record with its page; the page's text has its own fingerprint in the table of versions."""
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    rows = table(spark, d, "source_products").select(
        "record_id", "source_url", F.struct(F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), blank("description"), "external_id", "last_modified", "source_name", "source_url", blank("tagline"), "website_url").alias("source")
    ).distinct()
    picked = F.max(F.struct("page_id", blank("description"), "final_url", "skipped_reason", blank("title"))).alias("m")
    pages = table(spark, d, "external_pages").groupBy("source_url").agg(picked)
    joined = rows.join(pages, "source_url", "left")
    page = F.when(F.col("m").isNotNull(), F.struct("m.description", "m.final_url", "m.skipped_reason", "m.title"))
    return joined.select("record_id", C.content_hash(F.col("source"), page).alias("hash"))


_STORED = f"""sto as (select source_url, 'ph-' || left(sha256(source_url), 24) as id, published_slug as slug, '{CREATED}' as created_at, draft_name_normalized as name, 'stored' as category
  from cur where published_slug is not null),
own as (select source_url, max(struct_pack(d := draft_id, n := name, c := category)) as m from catalog_drafts group by 1),
drf as (select c.source_url, c.published_slug, own.m.n as name, own.m.c as category from cur c join own using (source_url) where c.draft_name_normalized is not null)"""


def _public(spark, d):
    items = _items(spark, d).filter(K.has_draft())
    own = table(spark, d, "catalog_drafts").groupBy("source_url").agg(F.max(F.struct("draft_id", "name", "category")).alias("m"))
    drafts = items.join(own, "source_url").select("source_url", "published_slug", "m.name", "m.category")
    stored = _items(spark, d).filter("published_slug is not null").select(
        "source_url", C.stable_id(F.col("source_url"), "ph").alias("id"), F.col("published_slug").alias("slug"), F.lit(CREATED).alias("created_at"),
        F.col("draft_name_normalized").alias("name"), F.lit("stored").alias("category"),
    )
    return drafts, stored


def _public_sql(old: str, new: str) -> str:
    return f"""with {_CUR}, {_STORED} select d.source_url, coalesce(s.id, 'ph-' || left(sha256(d.source_url), 24)) as id,
 coalesce(s.slug, d.published_slug, 'ph-' || left(sha256(d.source_url), 24)) as slug, coalesce(s.created_at, '{CREATED}') as created_at,
 {old} as name, {new} as category, s.id is null as created from drf d left join sto s using (source_url)"""


@query(_public_sql("d.name", "d.category"))
def q_public_merge(spark, d):
    drafts, stored = _public(spark, d)
    return K.public_records(drafts, stored, CREATED, verbatim=False)


@query(_public_sql("case when s.id is null then d.name else s.name end", "case when s.id is null then d.category else s.category end"))
def q_export(spark, d):
    drafts, stored = _public(spark, d)
    return K.public_records(drafts, stored, CREATED, verbatim=True)


@query(f"""with {_CUR}, pub as (select published_slug as slug, min(source_url) as id, max(draft_name_normalized) as name from cur where published_slug is not null group by 1),
ed as (select distinct 'x-' || draft_id as slug, name from catalog_drafts union all select p.slug, d.name from pub p join (select source_url, min(name) as name from catalog_drafts group by 1) d on d.source_url = p.id),
fin as (select p.slug, e.name is not null as edited, replace({_FOLD.format('coalesce(e.name, p.name)')}, ' ', '') as key from pub p left join (select slug, max(name) as name from ed group by 1) e using (slug))
select distinct slug, 'unknown slug' as reason from ed where slug not in (select slug from pub)
union all select slug, 'duplicate final name' from fin where edited and key in (select key from fin group by key having count(*) > 1 and bool_or(edited))""")
def q_file_edits(spark, d):
    public = _items(spark, d).filter("published_slug is not null").groupBy(F.col("published_slug").alias("slug")).agg(
        F.min("source_url").alias("id"), F.max("draft_name_normalized").alias("name")
    ).withColumn("created_at", F.lit(CREATED))
    names = table(spark, d, "catalog_drafts")
    strangers = names.select(F.concat(F.lit("x-"), F.col("draft_id").cast("string")).alias("slug"), "name").distinct()
    own = public.select("slug", F.col("id").alias("source_url")).join(names.groupBy("source_url").agg(F.min("name").alias("name")), "source_url").select("slug", "name")
    edits = strangers.unionByName(own).select("slug", "name", F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("created_at"))
    return K.edit_rejections(edits, public)


# -- replies -------------------------------------------------------------------


@query("""with j as (select distinct run_id || '|' || source_url as id from run_items where outcome = 'started'),
r as (select run_id || '|' || source_url as id, count(*) as n from run_items where outcome in ('done', 'failed') group by 1)
select coalesce(j.id, r.id) as id, case when j.id is null then 'unknown' when r.id is null then 'missing' when n > 1 then 'duplicate' else 'once' end as verdict from j full join r on j.id = r.id""")
def q_reconcile_items(spark, d):
    log = table(spark, d, "run_items").select("outcome", F.concat_ws("|", F.col("run_id").cast("string"), "source_url").alias("id")).filter("id is not null")
    return K.reconcile(log.filter("outcome in ('done', 'failed')"), log.filter("outcome = 'started'").select("id").distinct())


@query(f"with r as (with {'j as (select distinct run_id, source_url from run_items where outcome = ' + chr(39) + 'started' + chr(39) + ')'} select * from j) select run_id, count(*) as started from r group by 1")
def q_started_per_run(spark, d):
    return table(spark, d, "run_items").filter("outcome = 'started'").select("run_id", "source_url").distinct().groupBy("run_id").agg(F.count("*").alias("started"))


@query("""with s as (select distinct run_id, source_url from run_items where outcome = 'started'), f as (select distinct run_id, source_url from run_items where outcome = 'done')
select coalesce(s.run_id, f.run_id) as run_id, count(*) filter (s.run_id is null or f.run_id is null) = 0 as acknowledged from s full join f on s.run_id = f.run_id and s.source_url = f.source_url group by 1""")
def q_ack_check(spark, d):
    log = table(spark, d, "run_items").filter("source_url is not null")
    return acknowledged(log.filter("outcome = 'started'"), log.filter("outcome = 'done'"), "run_id", "source_url")


_ACCEPT = [f for f in D.TEXT_LIMITS] + [f for f in D.LIST_LIMITS]


@query(f"""with x as (select distinct draft_id, name, intent_key, list_filter([{_CHECKS}], lambda r: r is not null) as bad, {_NAME.format('name')} as nn from catalog_drafts),
v as (select draft_id, nn, case when draft_id % 7 = 0 then 'missing from response' when draft_id % 11 = 0 then 'duplicate id in response'
  when intent_key is null or intent_key not in ({', '.join(repr(k) for k in D.INTENTS)}) then 'invalid intentKey' when len(bad) > 0 then 'schema/field validation failed' end as v from x)
select cast(draft_id as varchar) as id, case when v is not null then v when row_number() over (partition by nn, v is null order by draft_id) > 1 then 'replacement name already exists' else 'accepted' end as verdict from v""")
def q_acceptance_ladder(spark, d):
    rows = _drafts(spark, d)
    product = F.struct(*_ACCEPT, "intent_key").alias("product")
    items = rows.filter("draft_id % 7 <> 0").select(F.col("draft_id").alias("pos"), F.col("draft_id").cast("string").alias("id"), product, F.lit(False).alias("extra_fields"), F.array().cast("array<string>").alias("issues"))
    items = items.union(items.filter("pos % 11 = 0"))
    none = spark.createDataFrame([], "name_normalized string")
    return D.acceptance(items, rows.select(F.col("draft_id").cast("string").alias("id")), none)


@query(f"""select intent_key, count(*) as drafts from (select distinct draft_id, intent_key from catalog_drafts) where intent_key in ({', '.join(repr(k) for k in D.INTENTS)})
 and intent_key not in (select distinct intent_key from catalog_drafts where draft_id % 400 = 0 and intent_key is not null) group by 1""")
def q_intents_antijoin(spark, d):
    rows = table(spark, d, "catalog_drafts").select("draft_id", "intent_key").distinct()
    sent = rows.filter("draft_id % 400 = 0 and intent_key is not null").select("intent_key").distinct()
    known = D.intents(spark).select(F.col("key").alias("intent_key"))
    return rows.join(F.broadcast(known), "intent_key", "left_semi").join(sent, "intent_key", "left_anti").groupBy("intent_key").agg(F.count("*").alias("drafts"))


@query(f"select count(*) as entries, count(distinct url) as urls, (select count(*) from sitemap_entries) as listed from ({_ENTRIES})")
def q_sitemap_total(spark, d):
    listed = table(spark, d, "sitemap_entries").agg(F.count("*").alias("listed"))
    return q_sitemap_entries(spark, d).agg(F.count("*").alias("entries"), F.countDistinct("url").alias("urls")).crossJoin(F.broadcast(listed))  # one row each


@query("""with j as (select distinct run_id || '|' || source_url as id from run_items where outcome = 'started'),
r as (select run_id || '|' || source_url as id, count(*) as n from run_items where outcome in ('done', 'failed') group by 1),
v as (select case when j.id is null then 'unknown' when r.id is null then 'missing' when n > 1 then 'duplicate' else 'once' end as verdict from j full join r on j.id = r.id)
select verdict, count(*) as n from v group by 1""")
def q_anomalies(spark, d):
    """How often each sort of reply occurs."""
    return q_reconcile_items(spark, d).groupBy("verdict").agg(F.count("*").alias("n"))


@query(f"""with p as (select distinct record_id, source_url, external_id, source_name, tagline, description, website_url, categories from source_products),
e as (select source_url, max(struct_pack(i := page_id, u := final_url, r := skipped_reason, t := coalesce(title, ''), d := coalesce(description, ''))) as m from external_pages group by 1)
select record_id, external_id, source_name, left(tagline, 800) as tagline, rtrim(left(description, 4000)) as description, categories[1:12] as categories,
 case when m.r is null then coalesce(m.u, website_url) else website_url end as website, case when m.r is null then left(m.t, 300) end as page_title, case when m.r is null then left(m.d, 1500) end as page_description
from p left join e using (source_url)""")
def q_import_records(spark, d):
    """Records as the single-item payload and the import take them: whole fields within their limits, the page's part unless it was skipped."""
    rows = table(spark, d, "source_products").select("record_id", "source_url", "external_id", "source_name", "tagline", "description", "website_url", "categories").distinct()
    page = table(spark, d, "external_pages").groupBy("source_url").agg(
        F.max(F.struct("page_id", "final_url", "skipped_reason", F.coalesce("title", F.lit("")).alias("t"), F.coalesce("description", F.lit("")).alias("d"))).alias("m")
    )
    used = F.col("m.skipped_reason").isNull()
    cut = lambda c, n: F.substring(c, 1, n)
    return rows.join(page, "source_url", "left").select(
        "record_id", "external_id", "source_name", cut("tagline", 800).alias("tagline"), F.rtrim(cut("description", 4000)).alias("description"), F.slice("categories", 1, 12).alias("categories"),
        F.when(used, F.coalesce("m.final_url", "website_url")).otherwise(F.col("website_url")).alias("website"), F.when(used, cut("m.t", 300)).alias("page_title"), F.when(used, cut("m.d", 1500)).alias("page_description"),
    )


@query("""with x as (select distinct record_id, tagline, description from source_products)
select record_id, pos, part from (select record_id, unnest([1, 2]) as pos, unnest([tagline, description]) as part from x) where part is not null and part <> ''""")
def q_source_parts(spark, d):
    """The non-empty texts of each record, one row each."""
    rows = table(spark, d, "source_products").select("record_id", "tagline", "description").distinct()
    parts = rows.select("record_id", F.posexplode(F.array("tagline", "description")).alias("pos", "part"))
    return parts.filter("part is not null and part <> ''").select("record_id", (F.col("pos") + 1).alias("pos"), "part")


@query(f"""with {_CUR} select count(*) as selected, count(*) filter (status = 'published') as published, count(*) filter (status = 'failed') as failed,
 count(*) filter (external_checked) as external_checked, count(*) filter (draft_name_normalized is not null) as transformed from cur""")
def q_run_counters(spark, d):
    return _items(spark, d).agg(
        F.count("*").alias("selected"), F.count_if(F.col("status") == "published").alias("published"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if("external_checked").alias("external_checked"), F.count_if(K.has_draft()).alias("transformed"),
    )


@query("""select source_url, least(60000, 2048 + 1200 * count(*)) as output_cap, sum(len(left(coalesce(tagline, ''), 500)) + len(left(coalesce(description, ''), 2200)))::bigint as size
from (select distinct record_id, source_url, tagline, description from source_products) group by 1""")
def q_payload_bounds(spark, d):
    rows = table(spark, d, "source_products").select("record_id", "source_url", "tagline", "description").distinct()
    cut = lambda c, n: F.length(F.substring(F.coalesce(c, F.lit("")), 1, n))
    return rows.groupBy("source_url").agg(F.least(F.lit(60000).cast("long"), 2048 + 1200 * F.count("*")).alias("output_cap"), F.sum(cut("tagline", 500) + cut("description", 2200)).alias("size"))


_ESCAPED = r"len({0}) + 5 * len(regexp_replace({0}, '[\x00-\x7F]', '', 'g')) + 6 * len(regexp_replace({0}, '[\x00-\x{{FFFF}}]', '', 'g'))"


@query(f"""with x as (select record_id, left(tagline, 500) as title, left(description, 2200) as description, categories[1:8] as categories, (row_number() over (order by record_id) - 1) // 10 as batch
  from (select distinct record_id, tagline, description, categories from source_products)),
p as (select batch, '[' || string_agg(to_json({{'record_id': record_id, 'title': coalesce(title, ''), 'description': coalesce(description, ''), 'categories': coalesce(categories, [])}})::varchar, ',') || ']' as t from x group by batch)
select batch, cast(ceil(({_ESCAPED.format('t')}) / 3) as bigint) as tokens from p""")
def q_payload_tokens(spark, d):
    """Token estimates of request payloads of ten products."""
    rows = _products(spark, d).select("record_id", F.struct("record_id", F.coalesce(F.substring("tagline", 1, 500), F.lit("")).alias("title"), F.coalesce(F.substring("description", 1, 2200), F.lit("")).alias("description"), F.coalesce(F.slice("categories", 1, 8), F.array().cast("array<string>")).alias("categories")).alias("r"))
    grouped = K.numbered_groups(rows, ["record_id"], 10).groupBy("batch").agg(F.to_json(F.array_sort(F.collect_list("r"))).alias("payload"))
    return grouped.select("batch", C.token_estimate(F.col("payload")).alias("tokens"))


@query(r"""with x as (select distinct draft_id, name, '{"items":[{"id":' || draft_id || ',"name":' || to_json(name)::varchar || '},{"id":' || (-draft_id) || ',"name":' || to_json(name)::varchar || '}]}' as t from catalog_drafts where name is not null)
select draft_id, cast(len(regexp_extract_all(left(t, len(t) * 2 // 3), '"\}')) as integer) as kept from x""")
def q_salvage(spark, d):
    """Complete drafts of replies cut at two thirds."""
    rows = _drafts(spark, d).filter("name is not null").select("draft_id", F.to_json(F.struct(F.array(F.struct(F.col("draft_id").alias("id"), "name"), F.struct((-F.col("draft_id")).alias("id"), "name")).alias("items"))).alias("t"))
    cut = F.expr("substring(t, 1, length(t) * 2 div 3)")
    return rows.select("draft_id", F.size(D.salvage_items(cut)).alias("kept"))


@query("select distinct draft_id, trim(name) as text from catalog_drafts where trim(name) <> ''")
def q_reply_text(spark, d):
    part = lambda text, thought: F.struct(text.alias("text"), F.lit(thought).alias("thought"))
    content = F.struct(F.struct(F.array(part(F.lit("hm"), True), part(F.col("name"), False)).alias("parts")).alias("content"))
    rows = table(spark, d, "catalog_drafts").select("draft_id", "name").distinct()
    text = D.reply_text(F.to_json(F.struct(F.array(content).alias("candidates"))))
    return rows.select("draft_id", text.alias("text")).filter("text is not null")


@query(f"""with x as (select distinct final_url as url, coalesce(title, '') as title, text from external_pages where text is not null)
select url, rtrim(left({_COLLAPSE.format('title')}, 300)) as title, '' as description, rtrim(left({_COLLAPSE.format("title || ' ' || title || ' ' || text")}, 6000)) as text from x""")
def q_html_signals(spark, d):
    """Page records out of HTML built from the recorded pages."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    title = escaped(F.coalesce("title", F.lit("")))
    pages = table(spark, d, "external_pages").filter("text is not null").select(
        F.col("final_url").alias("url"),
        F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body><nav>Menu</nav><h1>"), title, F.lit("</h1><p>"), F.replace(escaped(F.col("text")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p></body></html>")).alias("html"),
    ).distinct()
    return W.external_pages(pages)


@query("""select host, position, delay, coalesce(sum(delay) over (partition by host order by position rows between unbounded preceding and 1 preceding), 0.0) as starts_after
from (select distinct page_id as position, lower(split_part(split_part(final_url, '://', 2), '/', 1)) as host, 2.0 + (page_id % 3) / 2.0 as delay from external_pages where final_url is not null)""")
def q_pacing_schedule(spark, d):
    from loomspan.operators.quota import pacing

    host = F.lower(F.split(F.split("final_url", "://").getItem(1), "/").getItem(0))
    rows = table(spark, d, "external_pages").filter("final_url is not null").select(F.col("page_id").alias("position"), host.alias("host"), (2.0 + (F.col("page_id") % 3) / 2.0).alias("delay")).distinct()
    return pacing(rows)


@query("""select page_id, case when skipped_reason like 'http-error:%' and try_cast(split_part(skipped_reason, ':', 2) as integer) in (429, 500, 502, 503, 504) or skipped_reason = 'http-error:network' then true else false end as retry
from (select distinct page_id, skipped_reason from external_pages where skipped_reason is not null)""")
def q_retryable(spark, d):
    rows = table(spark, d, "external_pages").filter("skipped_reason is not null").select("page_id", "skipped_reason").distinct()
    status = F.regexp_extract("skipped_reason", r"^http-error:(\d+)$", 1).try_cast("int")
    return rows.select("page_id", F.coalesce(status.isin(*C.RETRYABLE_STATUS), F.col("skipped_reason") == "http-error:network").alias("retry"))


@query("""select entry_id, attempt, greatest(least(120.0, pow(2, attempt - 1) + (entry_id % 4) / 2.0), case when entry_id % 5 = 0 then 30.0 else 0.0 end) as wait from (select distinct entry_id, attempt from run_items)""")
def q_backoff(spark, d):
    """The wait before each attempt: doubled, with jitter, at least what the server asked for."""
    rows = table(spark, d, "run_items").select("entry_id", "attempt").distinct()
    asked = F.when(F.col("entry_id") % 5 == 0, F.lit(30.0))
    return rows.select("entry_id", "attempt", C.backoff(F.col("attempt"), (F.col("entry_id") % 4) / 2.0, asked).alias("wait"))


@query("""select page_id, case when page_id % 3 = 0 then true when page_id % 5 = 0 then true else not (starts_with(final_url, 'https://') or starts_with(final_url, 'http://')) end as refused
from (select distinct page_id, final_url from external_pages where final_url is not null)""")
def q_redirects(spark, d):
    """Redirects that must not be followed: of requests that send something, with credentials, or to no public address."""
    rows = table(spark, d, "external_pages").filter("final_url is not null").select("page_id", "final_url").distinct()
    method = F.when(F.col("page_id") % 3 == 0, "POST").otherwise("GET")
    return rows.select("page_id", C.redirect_refused(method, F.col("page_id") % 5 == 0, C.url_refusal(F.col("final_url"))).alias("refused"))


@query(f"""select record_id, greatest(1, least(25, coalesce(case when record_id % 4 > 0 then record_id % 40 end, 7)))::integer as batch, left(sha256(source_url), 16) as fingerprint,
 list_filter(list_transform(string_split(source_name || ', ' || coalesce(tagline, ''), ','), lambda x: {_COLLAPSE.format('x')}), lambda x: x <> '') as parts, left(trim(coalesce(description, ''), ' '), 2000) as error
from (select distinct record_id, source_url, source_name, tagline, description from source_products)""")
def q_request_fields(spark, d):
    """The clamped batch size, the key's fingerprint, listed names and the stored error text of a request."""
    rows = table(spark, d, "source_products").select("record_id", "source_url", "source_name", "tagline", "description").distinct()
    listed = F.concat(F.col("source_name"), F.lit(", "), F.coalesce("tagline", F.lit("")))
    return rows.select(
        "record_id", C.clamp_batch(F.when(F.col("record_id") % 4 > 0, F.col("record_id") % 40)).cast("int").alias("batch"), C.fingerprint(F.col("source_url")).alias("fingerprint"),
        C.string_list(listed).alias("parts"), C.error_text(F.coalesce("description", F.lit(""))).alias("error"),
    )


@query(f"""select page_id, case when page_id % 11 = 0 then 'robots-disallowed' when page_id % 13 = 0 then 'http-error:404' when page_id % 17 = 0 then 'http-error:network'
 when page_id % 4 = 2 then 'unsupported-content-type:application/pdf' end as reason from (select distinct page_id from external_pages)""")
def q_skip_reasons(spark, d):
    """Why a recorded page gives no text, by the order of the checks."""
    rows = table(spark, d, "external_pages").select("page_id").distinct()
    i = F.col("page_id")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("text/html; charset=utf-8", "TEXT/PLAIN", "application/pdf", "")]), (i % 4 + 1).cast("int"))
    failed = (i % 13 == 0) | (i % 17 == 0)
    reason = W.skip_reason(F.lit(None).cast("string"), F.when(i % 11 == 0, "robots-disallowed"), F.when(i % 13 == 0, 404), failed, kinds)
    return rows.select("page_id", reason.alias("reason"))


@query(f"""select url, position from (select url, min(position) as position, arg_max(coalesce(last_modified, '~'), position) as m from ({_ENTRIES}) group by url)
order by {_EPOCH.format('m')} desc, position limit 50 offset 5""")
def q_discovered(spark, d):
    """Fifty newest entries after the first five, each URL once."""
    return W.discovered(q_sitemap_entries(spark, d), "newest", 5, 50).select("url", "position")
