"""Replay of recorded generation: rounds of batches, retries, and cycles that publish early."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomspan.functions import columns as C
from loomspan.operators import checkpoint as K, drafts as D
from loomspan.operators.positions import ordinals
from loomspan.session import persisted

TRIES, BATCH = 3, 50


def answered(requests: DataFrame) -> DataFrame:
    """(request, model, failures): the first model by preference that answered; null if none did.

    Columns: request, model, pref, status. Every model gets the same request;
    `failures` counts those before the one that answered.
    """
    fine = F.col("status") == 200
    best = requests.groupBy("request").agg(F.min_by(F.when(fine, F.col("model")), F.when(fine, F.col("pref"))).alias("model"), F.min(F.when(fine, F.col("pref"))).alias("_p"))
    joined = requests.join(best.withColumnRenamed("model", "_m"), "request")
    tried = joined.filter(F.col("_p").isNull() | (F.col("pref") <= F.col("_p")))
    return tried.groupBy("request").agg(F.first("_m").alias("model"), F.count_if(~F.coalesce(fine, F.lit(False))).alias("failures"))


def generate(jobs: DataFrame, replies: DataFrame, known_names: DataFrame, size: int = BATCH, tries: int = TRIES) -> tuple[DataFrame, DataFrame]:
    """(saved, unfinished) of a queue of jobs and the replies recorded for each try.

    `jobs`: id, pos. `replies`: id, try, pos, product, extra_fields, issues.
    `known_names`: name_normalized. A round takes the queue in batches of
    `size`; what is refused goes to its tail, so the failures of a round are the
    next round's queue in the same order. `saved`: id, try, batch and the
    accepted product; `unfinished`: id, verdict of the last of `tries` tries.
    Each round is written before the next begins, and what it accepted is saved
    whatever becomes of the others. Null ids are no jobs.
    """
    queue = jobs.filter("id is not null").select("id", "pos").dropDuplicates(["id"])
    names, saved, batches = known_names.select("name_normalized"), None, 0
    for attempt in range(1, tries + 1):
        numbered = ordinals(queue.select("id", "pos"), ["pos", "id"], "queue").withColumn("batch", F.floor(F.col("ordinal") / size) + batches)
        mine = replies.filter(F.col("try") == attempt).select("id", "pos", "product", "extra_fields", "issues")
        # Replies are judged in the order of their batches.
        placed = mine.drop("pos").join(numbered.select("id", F.col("ordinal").alias("pos")), "id")
        verdicts = D.acceptance(placed, numbered.select("id"), names)
        judged = persisted(numbered.join(verdicts, "id").withColumn("try", F.lit(attempt)), "round")
        accepted = judged.filter("verdict = 'accepted'").join(placed.select("id", "product"), "id").select("id", "try", "batch", "product")
        saved = accepted if saved is None else saved.unionByName(accepted)
        names = names.unionByName(accepted.select(C.normalized_name(F.col("product.name")).alias("name_normalized")))
        queue = judged.filter("verdict <> 'accepted'").select("id", "pos", "verdict")
        batches += -(-numbered.count() // size)
        if queue.isEmpty():
            break
    return saved, queue.select("id", "verdict")


def cycles(items: DataFrame, generated: DataFrame, size: int = BATCH, max_failures: int = K.MAX_FAILURES) -> DataFrame:
    """(cycle, step, source_url): what bounded cycles do, in order of cycle and step.

    `items` are work items in order of ordinal, `generated` the source_urls whose
    generation was accepted. A cycle of `size` items scrapes what lacks a part
    (step 1), publishes saved drafts (2) before it spends a request, generates
    (3) and publishes again (4). The first cycle in which a generation is left
    unfinished still publishes and is the last.
    """
    numbered = ordinals(items, ["ordinal", "source_url"], "cycles", "_number").withColumn("cycle", F.floor(F.col("_number") / size))
    rows = numbered.join(generated.select("source_url", F.lit(True).alias("_done")).distinct(), "source_url", "left")
    open_ = (F.col("status") != "published") & (F.col("attempts") < max_failures)
    lacks = open_ & (F.col("source_content_hash").isNull() | ~F.col("external_checked"))
    steps = F.array(
        F.when(lacks, 1), F.when((F.col("status") != "published") & K.has_draft(), 2), F.when((F.col("status") != "published") & K.ready(max_failures), 3),
        F.when((F.col("status") != "published") & K.ready(max_failures) & F.col("_done"), 4),
    )
    paused = rows.filter((F.col("status") != "published") & K.ready(max_failures) & F.col("_done").isNull()).agg(F.min("cycle").alias("_last"))
    done = rows.select("cycle", "source_url", F.explode(F.filter(steps, lambda x: x.isNotNull())).alias("step"))
    return done.crossJoin(F.broadcast(paused)).filter(F.col("_last").isNull() | (F.col("cycle") <= F.col("_last"))).select("cycle", "step", "source_url")  # one row


def acknowledged(sent: DataFrame, received: DataFrame, group: str, key: str) -> DataFrame:
    """(group, acknowledged): whether exactly the sent keys came back, no one missing and no one else's."""
    s, r = (x.select(group, key).distinct() for x in (sent, received))
    both = s.withColumn("_s", F.lit(1)).join(r.withColumn("_r", F.lit(1)), [group, key], "full_outer")
    return both.groupBy(group).agg((F.count_if(F.col("_s").isNull() | F.col("_r").isNull()) == 0).alias("acknowledged"))


def zipped(requests: DataFrame, results: DataFrame) -> DataFrame:
    """(request, pos, sent, got): lists of sent and returned records paired by position.

    Columns: request, sent and request, got, each an array. Lists of unequal
    length are an error of that request and give one row without a position.
    """
    both = requests.select("request", "sent").join(results.select("request", "got"), "request")
    equal = F.size("sent") == F.size("got")
    pairs = F.when(equal, F.arrays_zip("sent", "got"))
    rows = both.select("request", F.posexplode_outer(pairs).alias("pos", "pair"))
    return rows.select("request", "pos", F.col("pair.sent").alias("sent"), F.col("pair.got").alias("got"))


def settings(updates: DataFrame) -> DataFrame:
    """(key, value): the last value written to each key. Columns: key, value, at; ties go to the greatest value."""
    return updates.filter("key is not null").groupBy("key").agg(F.max(F.struct("at", "value")).alias("m")).select("key", "m.value")
