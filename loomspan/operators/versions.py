"""Tables of immutable versions, and processing only what changed between two.

A version is a JSON manifest that names Parquet files and deletion vectors
(positions of dead rows inside a file). Files are never rewritten: a merge adds
files for new and changed rows and a deletion vector for the rows they replace.
The difference of two manifests therefore gives the changed records without
comparing the tables: rows of added files, rows of removed files, and rows
newly named by a deletion vector.

A consumer stores the version it has processed inside the manifest of its own
output commit. Output and progress become visible in one atomic step, so a run
that fails before the commit is repeated as a whole and one that committed is
never repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Manifest:
    version: int
    files: tuple[str, ...] = ()
    vectors: tuple[str, ...] = ()
    meta: dict = field(default_factory=dict)


class VersionedTable:
    """An append-only chain of manifests over immutable Parquet files.

    A manifest holds one path per data file and one per deletion vector; it is
    metadata of the table, of the size such manifests have in any lake format.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._hpath = jvm.org.apache.hadoop.fs.Path
        self._fs = self._hpath(self.path).getFileSystem(self._conf)

    # -- manifests ---------------------------------------------------------

    def _manifest_path(self, version: int):
        return self._hpath(f"{self.path}/_versions/{version:012d}.json")

    def latest(self) -> Manifest | None:
        folder = self._hpath(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        found = [int(n[:12]) for n in names if n.endswith(".json")]
        return self.manifest(max(found)) if found else None

    def manifest(self, version: int) -> Manifest:
        stream = self._fs.open(self._manifest_path(version))
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        raw = json.loads(text)
        return Manifest(raw["version"], tuple(raw["files"]), tuple(raw["vectors"]), raw["meta"])

    def _publish(self, manifest: Manifest) -> Manifest:
        """Write the manifest under a private name, then rename it: all or nothing."""
        body = json.dumps(manifest.__dict__, sort_keys=True).encode("utf-8")
        private = self._hpath(f"{self.path}/_versions/.{uuid.uuid4().hex}")
        self._fs.mkdirs(private.getParent())
        stream = self._fs.create(private, True)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        target = self._manifest_path(manifest.version)
        if self._fs.exists(target) or not self._fs.rename(private, target):
            self._fs.delete(private, False)
            raise FileExistsError(f"version {manifest.version} of {self.path} was committed by another writer")
        return manifest

    # -- data --------------------------------------------------------------

    def _write(self, df: DataFrame, kind: str) -> list[str]:
        """Write new files; they belong to no version until a manifest names them."""
        folder = f"{self.path}/{kind}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(folder)
        listed = self._fs.listStatus(self._hpath(folder))
        return sorted(s.getPath().toString() for s in listed if s.getPath().getName().endswith(".parquet"))

    def _rows(self, files: tuple[str, ...] | list[str], schema) -> DataFrame:
        """Rows with their file and position; an empty list gives an empty frame."""
        if not files:
            return self.spark.createDataFrame([], schema).select("*", F.lit("").alias("_file"), F.lit(0).cast("long").alias("_row"))
        data = self.spark.read.schema(schema).parquet(*files)
        return data.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))

    def _dead(self, vectors) -> DataFrame | None:
        """Dead positions, never broadcast: they grow with the table, and the size of their files does not show it."""
        return self.spark.read.schema("_file string, _row long").parquet(*vectors).hint("merge") if vectors else None

    def _schema(self, manifest: Manifest):
        from pyspark.sql.types import StructType

        return StructType.fromJson(manifest.meta["schema"])

    def _live(self, manifest: Manifest, schema) -> DataFrame:
        rows, dead = self._rows(manifest.files, schema), self._dead(manifest.vectors)
        return rows if dead is None else rows.join(dead, ["_file", "_row"], "left_anti")

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.latest() if version is None else self.manifest(version)
        return self._live(manifest, self._schema(manifest)).drop("_file", "_row")

    # -- commits -----------------------------------------------------------

    def commit(self, df: DataFrame, mode: str = "append", meta: dict | None = None) -> Manifest:
        """`append` keeps the files of the last version; `replace` drops them."""
        last = self.latest()
        kept = last if last and mode == "append" else Manifest(last.version if last else 0)
        files = self._write(df, "data")
        schema = {"schema": df.schema.jsonValue()}
        return self._publish(Manifest(kept.version + 1, kept.files + tuple(files), kept.vectors, schema | (meta or {})))

    def merge(self, df: DataFrame, key: str, meta: dict | None = None) -> Manifest:
        """Upsert `df` by `key`, writing only rows that are new or differ.

        `df` must have unique non-null keys. Values compare null-safe. Rows of
        the table whose key is not in `df` stay.
        """
        last = self.latest()
        schema = self._schema(last)
        names = [c for c in schema.names if c != key]
        old = self._live(last, schema).select(
            F.col(key), F.struct(*names).alias("_old"), "_file", "_row"
        )
        new = df.select(F.col(key), F.struct(*names).alias("_new"))
        differs: Column = F.col("_file").isNull() | ~F.col("_old").eqNullSafe(F.col("_new"))
        from loomspan.session import persisted

        changed = persisted(new.join(old, key, "left").filter(differs), "merge")
        added = self._write(changed.select(*[F.col(c) if c == key else F.col(f"_new.{c}").alias(c) for c in schema.names]), "data")
        dead = self._write(changed.filter(F.col("_file").isNotNull()).select("_file", "_row"), "dead")
        return self._publish(
            Manifest(last.version + 1, last.files + tuple(added), last.vectors + tuple(dead), {"schema": last.meta["schema"]} | (meta or {}))
        )

    # -- differences -------------------------------------------------------

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """Record deltas of versions (since, until]: the table's columns plus `op`.

        `op` is `insert` for a row of an added file and `delete` for a row that
        a removed file or a new deletion vector took away. A row both added and
        deleted in between appears in neither form. since = 0 means everything.
        """
        after = self.latest() if until is None else self.manifest(until)
        schema = self._schema(after)
        before = self.manifest(since) if since else Manifest(0)
        old, new = set(before.files), set(after.files)
        fresh_vectors = tuple(v for v in after.vectors if v not in set(before.vectors))

        inserted = self._rows([f for f in after.files if f not in old], schema)
        fresh_dead = self._dead(fresh_vectors)
        if fresh_dead is not None:
            inserted = inserted.join(fresh_dead, ["_file", "_row"], "left_anti")
        out = inserted.withColumn("op", F.lit("insert"))

        gone = self._rows([f for f in before.files if f not in new], schema)
        old_dead = self._dead(before.vectors)
        if old_dead is not None:
            gone = gone.join(old_dead, ["_file", "_row"], "left_anti")
        out = out.unionByName(gone.withColumn("op", F.lit("delete")))
        if fresh_dead is not None:
            kept = self._rows([f for f in before.files if f in new], schema)
            out = out.unionByName(kept.join(fresh_dead, ["_file", "_row"], "left_semi").withColumn("op", F.lit("delete")))
        return out.drop("_file", "_row")


def process_changes(
    source: VersionedTable, sink: VersionedTable, fn: Callable[[DataFrame], DataFrame]
) -> Manifest | None:
    """Run `fn` over the records inserted since the sink's last commit, once.

    The processed version is part of the sink's commit. None if nothing is new.
    """
    done, newest = sink.latest(), source.latest()
    since = done.meta.get("processed", 0) if done else 0
    if newest is None or newest.version == since:
        return None
    delta = source.changes(since, newest.version).filter("op = 'insert'").drop("op")
    return sink.commit(fn(delta), meta={"processed": newest.version})


def latest_rows(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """One row per non-null key, the greatest by `order` (nulls lowest).

    A max over a struct, so it is combined on the map side and a key that holds
    a large part of all rows costs one row per task. Ties on `order` go to the
    greatest values, so repeated rows give one defined row.
    """
    picked = F.max(F.struct(*order, *[F.col(v).alias(f"v_{v}") for v in values])).alias("_m")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(picked)
        .select(key, *[F.col(f"_m.v_{v}").alias(v) for v in values])
    )
