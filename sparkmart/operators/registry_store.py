"""A stored registry: rows by key in hashed buckets, changed by rewriting the buckets touched.

``data/<change>/bucket_of_key=<n>`` holds the rows of a bucket as one change wrote them, and never changes.
A manifest names for each bucket the change that holds its rows now. A change reads the buckets
that its keys hash to, writes those anew, and then puts the next manifest in place, which is the one
step at which readers see it. So a small change costs its buckets and not the registry, readers
under way keep their files, and a change that fails leaves all as it was. Of two changes at once
the second to finish is refused, and can be made again.

The number of buckets is fixed when the registry is made; a bucket is a task's work, so choose it
by the size expected (a bucket of 256 MB or so). Keys are hashed and unique, so buckets are even.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.registry import insert_absent, update_columns

BUCKETS = 64
_BUCKET = "bucket_of_key"


class ConflictError(RuntimeError):
    """Another change was published first."""


@dataclass(frozen=True)
class Manifest:
    number: int
    key: str
    schema: str
    buckets: int
    changes: dict[int, str]


class _Files:
    """The few file operations on manifests, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._folder = self._path(folder)
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._system = self._folder.getFileSystem(conf)

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def names(self) -> list[str]:
        if not self._system.exists(self._folder):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self._folder)]

    def read(self, name: str) -> str:
        stream = self._system.open(self._path(self._folder, name))
        try:
            return self._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Put a whole file in place under a name not yet taken; whether that was done."""
        waiting = self._path(self._folder, f"_{uuid.uuid4().hex}")
        stream = self._system.create(waiting)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._path(self._folder, name)
        done = not self._system.exists(target) and self._system.rename(waiting, target)
        if not done:
            self._system.delete(waiting, False)
        return done

    def delete(self, name: str) -> None:
        self._system.delete(self._path(self._folder, name), True)


class RegistryStore:
    """The registry below ``path``; ``RegistryStore.create`` makes a new one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._manifests = _Files(spark, f"{self.path}/manifests")

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS
    ) -> RegistryStore:
        if key not in schema.names:
            raise ValueError(f"no column {key!r} to be the key")
        if _BUCKET in schema.names or buckets < 1:
            raise ValueError(f"a registry has a bucket or more, and no column {_BUCKET!r}")
        store = cls(spark, path)
        store._publish(Manifest(0, key, schema.json(), buckets, {}))
        return store

    # Reading

    def manifest(self) -> Manifest:
        names = [name for name in self._manifests.names() if name.endswith(".json")]
        if not names:
            raise LookupError(f"no registry below {self.path}")
        found = json.loads(self._manifests.read(max(names)))
        changes = {int(bucket): change for bucket, change in found.pop("changes").items()}
        return Manifest(**found, changes=changes)

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.manifest().schema))

    def read(self) -> DataFrame:
        """All rows as of now."""
        manifest = self.manifest()
        return self._rows(manifest, manifest.changes)

    def read_keys(self, keys: Sequence) -> DataFrame:
        """The rows of some keys, read from their buckets only."""
        manifest = self.manifest()
        kind = self.schema()[manifest.key].dataType
        wanted = self.spark.createDataFrame(
            [(key,) for key in keys], T.StructType([T.StructField(manifest.key, kind)])
        )
        rows = self._rows(manifest, self._touched(manifest, [wanted]))
        return rows.join(F.broadcast(wanted.distinct()), manifest.key, "left_semi")

    def _rows(self, manifest: Manifest, buckets: Sequence[int]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        paths = [
            f"{self.path}/data/{manifest.changes[bucket]}/{_BUCKET}={bucket}"
            for bucket in sorted(buckets)
            if bucket in manifest.changes
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # Changing

    def merge(
        self,
        inserts: DataFrame | None = None,
        arrival: Sequence[str] = (),
        updates: DataFrame | None = None,
        columns: Sequence[str] = (),
        order: Sequence[str] = (),
        named: str | None = None,
    ) -> tuple[DataFrame | None, DataFrame | None]:
        """Insert the rows of ``inserts`` whose keys are absent, then overwrite ``columns`` by
        ``updates``, as ``insert_absent`` and ``update_columns`` do, in one change.

        Gives the refused inserts and the updates with an unknown key. Columns of ``inserts`` that the
        registry has not are not stored; those it lacks are NULL.
        """
        manifest = self.manifest()
        key = manifest.key
        batches = [batch for batch in (inserts, updates) if batch is not None]
        touched = self._touched(manifest, batches)
        rows = before = self._rows(manifest, touched)
        refused = unknown = None
        if inserts is not None:
            accepted, refused = insert_absent(before, inserts, key, arrival)
            rows = before.unionByName(self._fitted(accepted, manifest))
        if updates is not None:
            rows, unknown = update_columns(rows, updates, key, columns, order, named)
        if touched:
            self._rewrite(manifest, rows, touched)
        return refused, unknown

    def _fitted(self, rows: DataFrame, manifest: Manifest) -> DataFrame:
        fields = T.StructType.fromJson(json.loads(manifest.schema)).fields
        return rows.select(
            *[
                (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in fields
            ]
        )

    def _touched(self, manifest: Manifest, batches: Sequence[DataFrame]) -> list[int]:
        """The buckets of the batches' keys: at most as many numbers as there are buckets."""
        found: set[int] = set()
        for batch in batches:
            buckets = batch.where(F.col(manifest.key).isNotNull()).select(
                self._bucket(manifest).alias(_BUCKET)
            )
            found |= {row[0] for row in buckets.distinct().collect()}
        return sorted(found)

    def _bucket(self, manifest: Manifest) -> Column:
        kind = self._kind(manifest)
        hashed = F.xxhash64(F.col(f"`{manifest.key}`").cast(kind))
        return F.pmod(hashed, F.lit(manifest.buckets)).cast("int")

    def _kind(self, manifest: Manifest) -> T.DataType:
        return T.StructType.fromJson(json.loads(manifest.schema))[manifest.key].dataType

    def _rewrite(self, manifest: Manifest, rows: DataFrame, touched: list[int]) -> None:
        change = uuid.uuid4().hex
        (
            rows.withColumn(_BUCKET, self._bucket(manifest))
            .repartition(len(touched), _BUCKET)
            .write.partitionBy(_BUCKET)
            .parquet(f"{self.path}/data/{change}")
        )
        written = _Files(self.spark, f"{self.path}/data/{change}").names()
        held = {int(name.split("=")[1]) for name in written if name.startswith(f"{_BUCKET}=")}
        changes = {b: c for b, c in manifest.changes.items() if b not in set(touched)}
        changes |= {bucket: change for bucket in touched if bucket in held}
        self._publish(replace(manifest, number=manifest.number + 1, changes=changes))

    def _publish(self, manifest: Manifest) -> None:
        text = json.dumps({**vars(manifest), "changes": manifest.changes})
        if not self._manifests.put(f"{manifest.number:020d}.json", text):
            raise ConflictError(f"change {manifest.number} of {self.path} is published already")

    def remove_superseded(self) -> list[str]:
        """Delete earlier manifests and the changes that hold no bucket any more; gives their names.

        Call it when no reader of an earlier state is left and no change is under way.
        """
        manifest = self.manifest()
        data = _Files(self.spark, f"{self.path}/data")
        old = sorted(set(data.names()) - set(manifest.changes.values()))
        for change in old:
            data.delete(change)
        for name in self._manifests.names():
            if name != f"{manifest.number:020d}.json":
                self._manifests.delete(name)
        return old
