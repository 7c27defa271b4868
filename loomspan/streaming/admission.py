"""Quota admission and checkpoint upserts as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomspan.operators.quota import Admission
from loomspan.session import shared_path


def admit_stream(requests: DataFrame, rpd: int, rpm: int, tpm: int) -> DataFrame:
    """Decide a stream of (scope, model, at, tokens) per scope and model, in time order per micro-batch.

    The state holds the calls of the last two days as parallel arrays.
    """

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = zip(*state.get) if state.exists else ()
        ledger = Admission(rpd, rpm, tpm, [(float(a), int(t)) for a, t in held])
        rows = pd.concat(list(frames)).sort_values(["us", "tokens"])
        rows["admitted"] = [ledger.claim(us / 1e6, int(n)) for us, n in zip(rows["us"], rows["tokens"])]
        state.update(([a for a, _ in ledger.calls], [n for _, n in ledger.calls]))
        yield rows[["scope", "model", "us", "tokens", "admitted"]]

    prepared = requests.select("scope", "model", F.unix_micros("at").alias("us"), F.col("tokens").cast("long").alias("tokens"))
    decided = prepared.groupBy("scope", "model").applyInPandasWithState(
        run, "scope string, model string, us long, tokens long, admitted boolean", "ats array<double>, tokens array<long>", "append", GroupStateTimeout.NoTimeout
    )
    return decided.select("scope", "model", F.timestamp_micros("us").alias("at"), "tokens", "admitted")


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available and read what it wrote."""
    spark = stream.sparkSession
    path = shared_path(spark, label)
    query = (
        stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).outputMode("append").start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def upsert_stream(snapshots: DataFrame, key: str, values: list[str], order: str, label: str) -> DataFrame:
    """Fold a stream of snapshots into a versioned table, one merge per micro-batch; a repeated batch changes nothing."""
    from loomspan.operators.versions import VersionedTable, latest_rows

    spark = snapshots.sparkSession
    table = VersionedTable(spark, shared_path(spark, label))

    def merge(batch: DataFrame, _: int) -> None:
        newest = latest_rows(batch, key, [order], [*values, order])
        last = table.latest()
        if last is None:
            table.commit(newest)
            return
        held = table.read().select(F.col(key), F.col(order).alias("_held"))
        newer = newest.join(held, key, "left").filter(F.col("_held").isNull() | (F.col(order) > F.col("_held"))).drop("_held")
        table.merge(newer, key)

    query = snapshots.writeStream.foreachBatch(merge).option("checkpointLocation", shared_path(spark, label + "-progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read()
