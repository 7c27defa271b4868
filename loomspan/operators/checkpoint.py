"""Checkpoint rows: selection, upserts, overlays, repair, export and edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomspan.functions import columns as C

MAX_FAILURES = 3


def current_items(snapshots: DataFrame) -> DataFrame:
    """One row per source_url, the latest by updated_at; ties go to the greatest row."""
    rest = [c for c in snapshots.columns if c not in ("source_url", "updated_at")]
    picked = F.max(F.struct("updated_at", *rest)).alias("m")
    return snapshots.filter("source_url is not null").groupBy("source_url").agg(picked).select("source_url", "m.*")


def has_draft() -> Column:
    return F.col("draft_name_normalized").isNotNull()


def ready(max_failures: int = MAX_FAILURES) -> Column:
    """Scraped, checked, without a draft and not failed too often."""
    return F.col("source_content_hash").isNotNull() & F.col("external_checked") & ~has_draft() & (F.col("attempts") < max_failures)


def stage_entries(items: DataFrame, stage: str, publish: bool = False, max_failures: int = MAX_FAILURES, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Eligible work of a stage in order; the filter comes before the slice, so finished work takes no place."""
    if stage == "publish":
        wanted = has_draft()
    elif stage == "generate" and not publish:
        wanted = ready(max_failures)
    else:
        wanted = has_draft() | ready(max_failures)
    out = items.filter((F.col("status") != "published") & wanted).orderBy("ordinal", "source_url")
    if offset:
        out = out.offset(offset)
    return out.limit(limit) if limit else out


def scrape_entries(items: DataFrame, max_failures: int = MAX_FAILURES) -> DataFrame:
    """Work that lacks a part, with which one."""
    open_ = (F.col("status") != "published") & (F.col("attempts") < max_failures)
    need = F.when(F.col("source_content_hash").isNull(), "source").when(~F.col("external_checked"), "external")
    return items.filter(open_).withColumn("needs", need).filter("needs is not null")


def pending(items: DataFrame, max_failures: int = MAX_FAILURES, limit: int | None = None) -> DataFrame:
    out = items.filter((F.col("status") != "published") & (F.col("attempts") < max_failures)).orderBy("ordinal", "source_url")
    return out.limit(limit) if limit else out


def status_counts(items: DataFrame) -> DataFrame:
    """Items per status and in total; an empty table has a total of 0."""
    counted = items.groupBy("status").agg(F.count("*").alias("n"))
    return counted.unionByName(counted.agg(F.lit("total").alias("status"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def enqueue(items: DataFrame, entries: DataFrame) -> DataFrame:
    """(source_url, external_id, last_modified, ordinal, status, added): upsert of numbered entries (url, last_modified, ordinal).

    New rows are queued; existing ones get only last_modified and ordinal.
    """
    new = entries.select(F.col("url").alias("source_url"), F.col("last_modified").alias("new_modified"), F.col("ordinal").alias("new_ordinal"), F.lit(True).alias("listed"))
    both = items.join(new, "source_url", "full_outer")
    listed, fresh = F.col("listed").isNotNull(), F.col("status").isNull()
    return both.select(
        "source_url", F.coalesce("external_id", C.url_tail(F.col("source_url"))).alias("external_id"),
        F.when(listed, F.col("new_modified")).otherwise(F.col("last_modified")).alias("last_modified"),
        F.when(listed, F.col("new_ordinal")).otherwise(F.col("ordinal")).cast("long").alias("ordinal"),
        F.coalesce("status", F.lit("queued")).alias("status"), fresh.alias("added"),
    )


def enqueue_clashes(items: DataFrame, entries: DataFrame) -> DataFrame:
    """(external_id, urls): identities that an enqueue would give to more than one URL; any refuses the whole batch."""
    known = items.select("source_url", F.coalesce("external_id", C.url_tail(F.col("source_url"))).alias("external_id"))
    new = entries.select(F.col("url").alias("source_url"), C.url_tail(F.col("url")).alias("external_id")).join(items.select("source_url"), "source_url", "left_anti")
    both = known.unionByName(new).distinct()
    return both.groupBy("external_id").agg(F.count("*").alias("urls")).filter("urls > 1")


def mark(items: DataFrame, updates: DataFrame, stage: str) -> DataFrame:
    """Items with a finished stage written in: `scraped`, `external`, `transformed` or `published`.

    Columns of `updates`: source_url, and for `transformed` name, model and hash,
    for `published` slug. A finished stage clears the failure; only `scraped`
    brings a queued or failed item on, later stages set their own status.
    """
    u = updates.dropDuplicates(["source_url"]).select(*[F.col(c).alias(c if c == "source_url" else "_" + c) for c in updates.columns], F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    sets = {
        "scraped": {"status": F.lit("scraped")}, "external": {"external_checked": F.lit(True)},
        "transformed": {"status": F.lit("transformed"), "draft_name_normalized": lambda: C.normalized_name(F.col("_name")), "generation_model": lambda: F.col("_model"), "source_content_hash": lambda: F.col("_hash")},
        "published": {"status": F.lit("published"), "published_slug": lambda: F.col("_slug")},
    }[stage]
    if stage != "external":
        sets = sets | {"failed_stage": F.lit(None), "error": F.lit(None)}
    joined = items.join(u, "source_url", "left")
    return joined.select(*[F.when(hit, sets[c]() if callable(sets[c]) and not hasattr(sets[c], "alias") else sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in items.columns])


def overlay(items: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply one update per item (source_url, outcome, model, hash, error): done, failed or nothing."""
    u = updates.select("source_url", F.col("outcome").alias("_o"), F.col("model").alias("_m"), F.col("content_hash").alias("_h"))
    done, failed = F.col("_o") == "done", F.col("_o") == "failed"
    joined = items.join(u, "source_url", "left")
    return joined.select(
        "source_url",
        F.when(done, "transformed").when(failed, "failed").otherwise(F.col("status")).alias("status"),
        F.when(failed, F.col("attempts") + 1).otherwise(F.col("attempts")).alias("attempts"),
        F.when(done, F.coalesce("_m", "generation_model")).otherwise(F.col("generation_model")).alias("generation_model"),
        F.when(done, F.col("_h")).otherwise(F.col("source_content_hash")).alias("source_content_hash"),
        F.when(done, F.lit(None)).when(failed, "transform").otherwise(F.col("failed_stage")).alias("failed_stage"),
    )


def reset_failures(items: DataFrame) -> DataFrame:
    """Failed items back to the last stage they had finished, without attempts."""
    back = F.when(has_draft(), "transformed").when(F.col("source_content_hash").isNotNull(), "scraped").otherwise("queued")
    was = F.col("status") == "failed"
    return items.select(
        "source_url", F.when(was, back).otherwise(F.col("status")).alias("status"), F.when(was, 0).otherwise(F.col("attempts")).alias("attempts"),
        F.when(~was, F.col("failed_stage")).alias("failed_stage"), F.when(~was, F.col("error")).alias("error"),
    )


def name_collisions(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Rows whose normalized name another row has; null names collide with none."""
    normalized = C.normalized_name(F.col(name))
    counted = rows.select(key, name, normalized.alias("name_normalized")).filter("name_normalized is not null")
    shared = counted.groupBy("name_normalized").agg(F.count("*").alias("rows")).filter("rows > 1")
    return counted.join(shared, "name_normalized").select(key, name, "name_normalized", "rows")


def blocked_names(items: DataFrame, sources: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(name_key): URL tails, brands and listed names, without the empty key."""
    parts = items.select(C.name_key(C.url_tail(F.col("source_url"))).alias("name_key"))
    parts = parts.union(sources.select(C.name_key(C.brand_identity(F.col("source_name")))))
    parts = parts.union(items.sparkSession.createDataFrame([("alphasentinel",), ("skillforge",)], "name_key string"))
    if extra is not None:
        parts = parts.union(extra.select(C.name_key(F.col("name"))))
    return parts.filter("name_key is not null and name_key <> ''").distinct()


def repaired(items: DataFrame, flagged: DataFrame) -> DataFrame:
    """Flagged items back to scraped without their draft; slug and identity stay."""
    hit = F.col("_hit").isNotNull()
    joined = items.join(flagged.select("source_url", F.lit(True).alias("_hit")).distinct(), "source_url", "left")
    clear = lambda c: F.when(~hit, F.col(c)).alias(c)
    return joined.select(
        "source_url", F.when(hit, "scraped").otherwise(F.col("status")).alias("status"), F.when(hit, 0).otherwise(F.col("attempts")).alias("attempts"),
        clear("draft_name_normalized"), clear("generation_model"), clear("source_content_hash"), clear("failed_stage"), "published_slug",
    )


def public_records(drafts: DataFrame, stored: DataFrame, created_at: str, verbatim: bool) -> DataFrame:
    """Public record per draft: the stored identity where there is one, else a new stable one.

    `verbatim` keeps the stored fields (export); otherwise the draft's win (publish).
    """
    s = stored.select("source_url", F.col("id").alias("_id"), F.col("slug").alias("_slug"), F.col("created_at").alias("_at"), F.col("name").alias("_name"), F.col("category").alias("_category"))
    joined = drafts.join(s, "source_url", "left")
    known, own = F.col("_id").isNotNull(), C.stable_id(F.col("source_url"), "ph")
    pick = (lambda old, new: F.when(known, F.col(old)).otherwise(F.col(new))) if verbatim else (lambda old, new: F.col(new))
    return joined.select(
        "source_url", F.coalesce("_id", own).alias("id"), F.coalesce("_slug", "published_slug", own).alias("slug"),
        F.coalesce("_at", F.lit(created_at)).alias("created_at"), pick("_name", "name").alias("name"), pick("_category", "category").alias("category"), (~known).alias("created"),
    )


def edit_rejections(edits: DataFrame, public: DataFrame) -> DataFrame:
    """(slug, reason): why a batch of edits (slug, id, created_at, name) is refused; empty if it is fine.

    A name clash counts only if an edited row takes part in it.
    """
    counts = edits.groupBy("slug").agg(F.count("*").alias("n"))
    doubled = counts.filter("n > 1").select("slug", F.lit("duplicate input slug").alias("reason"))
    unknown = edits.join(public, "slug", "left_anti").select("slug", F.lit("unknown slug").alias("reason")).distinct()
    known = public.select("slug", F.col("id").alias("_id"), F.col("created_at").alias("_at"))
    matched = edits.join(known, "slug")
    changed = matched.filter((F.coalesce("id", "_id") != F.col("_id")) | (F.coalesce("created_at", "_at") != F.col("_at"))).select("slug", F.lit("identity changed").alias("reason")).distinct()
    final = public.select("slug", F.col("name").alias("_old")).join(edits.groupBy("slug").agg(F.max("name").alias("_new")), "slug", "left")
    keyed = final.select("slug", C.name_key(F.coalesce("_new", "_old")).alias("key"), F.col("_new").isNotNull().alias("edited"))
    clash = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("edited").alias("any")).filter("n > 1 and any")
    clashes = keyed.filter("edited").join(clash, "key").select("slug", F.lit("duplicate final name").alias("reason"))
    return doubled.unionByName(unknown).unionByName(changed).unionByName(clashes)


def applied_edits(edits: DataFrame, public: DataFrame) -> DataFrame:
    """Public records with the edits applied, all or nothing."""
    if not edit_rejections(edits, public).isEmpty():
        raise ValueError("the edits are refused; see edit_rejections")
    new = edits.select("slug", F.col("name").alias("_new"))
    return public.join(new, "slug", "left").withColumn("name", F.coalesce("_new", "name")).drop("_new")


def edited_items(items: DataFrame, edits: DataFrame, public: DataFrame) -> DataFrame:
    """Items with accepted edits (slug, name) as their drafts, to be published again; all or nothing.

    A snapshot is written as a whole, so names may be swapped without an
    intermediate clash.
    """
    final = applied_edits(edits, public)
    changed = edits.select("slug").join(final, "slug").select(F.col("slug").alias("published_slug"), F.col("name").alias("_new"))
    return items.join(changed, "published_slug", "left").select(
        *[
            F.when(F.col("_new").isNotNull(), {"status": F.lit("transformed"), "draft_name_normalized": C.normalized_name(F.col("_new"))}[c]).otherwise(F.col(c)).alias(c) if c in ("status", "draft_name_normalized") else F.col(c)
            for c in items.columns
        ]
    )


def reconcile(replies: DataFrame, jobs: DataFrame) -> DataFrame:
    """(id, verdict): exactly once, missing, duplicate or unknown."""
    counted = replies.groupBy("id").agg(F.count("*").alias("n"))
    both = jobs.select("id", F.lit(True).alias("asked")).join(counted, "id", "full_outer")
    verdict = F.when(F.col("asked").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").otherwise("once")
    return both.select("id", verdict.alias("verdict"))


def numbered_groups(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds `ordinal` from 0 and its group of `size` rows."""
    from loomspan.operators.positions import ordinals

    numbered = ordinals(rows, order)
    return numbered.withColumn("batch", F.floor(F.col("ordinal") / size))
