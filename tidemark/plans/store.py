"""Target tables as parquet snapshots.

Plain parquet tables cannot be merged into, and a folder cannot be overwritten
while it is read. So each write goes to a new folder, and a small version file
then names the folders that make up the table. Readers look the newest version
file up once per query: they see the old table or the new one, and a job that
dies halfway leaves nothing but an unnamed folder.

    <root>/<schema>/<table>/data/v=<version>/_bucket=<n>/part-*.parquet
    <root>/<schema>/<table>/versions/<version>.json

Rows are kept in buckets by key hash, and within a bucket in files sorted by key. A
merge first looks for the files that hold its keys, by reading key columns of the
buckets the keys fall in; it rewrites these files and names all others again. One
table has one writer at a time, as one task per table always gave.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, StructType

from tidemark.functions import any_null, bucket_of, key_list
from tidemark.functions.exprs import watermark_value
from tidemark.operators import merge
from tidemark.sources.scans import fresh_folder

BUCKET = "_bucket"
DEFAULT_BUCKETS = 16
ROWS_PER_BUCKET = 2_000_000
ROWS_PER_FILE = 250_000
MAX_BUCKETS = 8_192
#: A bucket that has gathered so many small writes is rewritten whole when it is next hit.
COMPACT_AFTER = 64
BROADCAST_KEY_BYTES = 8 << 20


def buckets_for(rows: int) -> int:
    """Buckets for a table of ``rows``: one for a small table, a power of two beyond."""
    buckets = 1
    while buckets < MAX_BUCKETS and rows > buckets * ROWS_PER_BUCKET:
        buckets *= 2
    return buckets


class Folder:
    """The few Hadoop file calls the store needs, on any file system Spark can write."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm, self.path = spark._jvm, path
        self._new_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._new_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utils = jvm.org.apache.hadoop.io.IOUtils
        self._bytes = jvm.java.io.ByteArrayOutputStream

    def names(self, child: str = "") -> list[str]:
        path = self._new_path(f"{self.path}/{child}" if child else self.path)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def write_text(self, name: str, text: str) -> None:
        """Write a file that appears whole under its name, or not at all."""
        hidden = self._new_path(f"{self.path}/.{name}.tmp")
        stream = self._fs.create(hidden, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        final = self._new_path(f"{self.path}/{name}")
        if self._fs.exists(final) or not self._fs.rename(hidden, final):
            raise RuntimeError(f"{final.toString()} already exists: the table has another writer")

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._new_path(f"{self.path}/{name}"))
        sink = self._bytes()
        self._utils.copyBytes(stream, sink, 65536, True)
        return bytes(sink.toByteArray()).decode()

    def remove(self, child: str = "") -> None:
        self._fs.delete(self._new_path(f"{self.path}/{child}" if child else self.path), True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this package has written."""
    Folder(spark, path).remove()


#: A write's whole folder of a bucket, by its number, or one of its files: ``number/name``.
Part = int | str


def number_of(part: Part) -> int:
    return int(str(part).partition("/")[0])


def writes(parts: Sequence[Part]) -> int:
    return len({number_of(p) for p in parts})


@dataclass
class Version:
    """What a table is made of: for each bucket the parts that hold its rows.

    ``applied`` is what a stream has brought: its last batch and the highest log position.
    """

    number: int
    schema: StructType
    keys: list[str]
    buckets: int
    parts: dict[int, list[Part]] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "number": self.number,
                "schema": self.schema.jsonValue(),
                "keys": self.keys,
                "buckets": self.buckets,
                "parts": {str(b): v for b, v in sorted(self.parts.items())},
                "applied": self.applied,
            }
        )

    @staticmethod
    def from_json(text: str) -> Version:
        raw = json.loads(text)
        parts = {int(b): v for b, v in raw["parts"].items()}
        schema = StructType.fromJson(raw["schema"])
        applied = raw.get("applied", {})
        return Version(raw["number"], schema, raw["keys"], raw["buckets"], parts, applied)


class DuplicateKeyError(ValueError):
    """A batch holds one key more than once."""


class SnapshotTable:
    """One target table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, self.path)
        self._versions = Folder(spark, f"{self.path}/versions")
        self._lock = threading.RLock()

    # --- reading ----------------------------------------------------------------------

    def current(self) -> Version | None:
        names = [n for n in self._versions.names() if n.endswith(".json") and n[0] != "."]
        return Version.from_json(self._versions.read_text(names[-1])) if names else None

    def exists(self) -> bool:
        return self.current() is not None

    def _require(self) -> Version:
        version = self.current()
        if version is None:
            raise LookupError(f"table {self.path} does not exist")
        return version

    def _read(self, version: Version, parts: dict[int, list[Part]] | None = None) -> DataFrame:
        paths = []
        for bucket, chosen in sorted((version.parts if parts is None else parts).items()):
            for part in chosen:
                name = "" if isinstance(part, int) else part.partition("/")[2]
                paths.append(f"{self.path}/data/v={number_of(part)}/{BUCKET}={bucket}/{name}")
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._read(self._require())

    def columns(self) -> list[str]:
        version = self.current()
        return version.schema.names if version else []

    def count(self) -> int:
        return self.read().count()

    def max_watermark(self, cdc_column: str | None):
        return self.read().agg(F.max(cdc_column)).first()[0] if cdc_column else None

    # --- writing ----------------------------------------------------------------------

    def _next(self, version: Version | None) -> int:
        """A number above every committed and every abandoned write."""
        written = [int(n[2:]) for n in self._folder.names("data") if n.startswith("v=")]
        return max([version.number if version else 0, *written]) + 1

    def _write(
        self,
        df: DataFrame,
        number: int,
        keys: Sequence[str],
        buckets: int,
        together: bool = False,
    ) -> list[int]:
        """Write rows by bucket, each file a range of a task's keys; the buckets that got rows.

        ``rebalance`` lets AQE merge small buckets' tasks and split a hot bucket
        over several tasks and files. It is left out where a bucket's rows are
        ``together`` in few tasks already, and for a single bucket.
        """
        df = df.withColumn(BUCKET, bucket_of(keys, buckets) if buckets > 1 else F.lit(0))
        if buckets > 1 and not together:
            df = df.hint("rebalance", BUCKET)
        if keys:
            df = df.sortWithinPartitions(BUCKET, *keys)
        writer = df.write.partitionBy(BUCKET).option("maxRecordsPerFile", ROWS_PER_FILE)
        writer.parquet(f"{self.path}/data/v={number}")
        names = self._folder.names(f"data/v={number}")
        return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]

    def _commit(self, version: Version) -> None:
        self._versions.write_text(f"{version.number:012d}.json", version.to_json())

    def create(
        self, schema: StructType, keys: str | Sequence[str] = (), buckets: int | None = None
    ) -> None:
        """An empty table; an error when it is there already."""
        with self._lock:
            if self.exists():
                raise ValueError(f"table {self.path} already exists")
            keys = key_list(keys)
            buckets = (buckets or DEFAULT_BUCKETS) if keys else 1
            self._commit(Version(self._next(None), schema, keys, buckets))

    def overwrite(
        self,
        df: DataFrame,
        keys: str | Sequence[str] = (),
        buckets: int | None = None,
        applied: dict[str, int] | None = None,
    ) -> None:
        """Replace all rows, and the schema with them; what streams have applied is kept."""
        with self._lock:
            old = self.current()
            number = self._next(old)
            keys = key_list(keys) or (old.keys if old else [])
            buckets = buckets or (old.buckets if old and old.keys == keys else None)
            buckets = (buckets or DEFAULT_BUCKETS) if keys else 1
            written = self._write(df, number, keys, buckets)
            parts = {b: [number] for b in written}
            marks = (old.applied if old else {}) | (applied or {})
            self._commit(Version(number, df.schema, keys, buckets, parts, marks))

    def append(self, df: DataFrame, compact_after: int = COMPACT_AFTER) -> None:
        """Add rows; the old folders stay as they are.

        A bucket that has gathered ``compact_after`` folders is rewritten with them, the
        others are left, so a table of many small appends stays quick to list.
        """
        with self._lock:
            old = self._require()
            rows = df.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields]
            )
            full = {b: ps for b, ps in old.parts.items() if writes(ps) >= compact_after}
            if full:
                rows = self._read(old, full).unionByName(rows)
            self._replace(old, full, rows, together=False)

    def _files(self, bucket: int, parts: Sequence[Part]) -> list[str]:
        """Parts of a bucket as single files."""
        files = []
        for part in parts:
            if isinstance(part, int):
                names = self._folder.names(f"data/v={part}/{BUCKET}={bucket}")
                files += [f"{part}/{n}" for n in names if n[0] not in "._"]
            else:
                files.append(part)
        return files

    def _touched(self, old: Version, facts: Row, keys: DataFrame) -> dict[int, list[Part]]:
        """Of the buckets hit, the files that hold one of the keys; at most one row a file.

        Only key columns are read, and of files sorted by key only row groups that reach into
        the span of the first key. A bucket of many small writes counts as touched whole.
        """
        hit = {b: old.parts[b] for b in facts["hit"] if b in old.parts}
        touched = {b: ps for b, ps in hit.items() if writes(ps) >= COMPACT_AFTER}
        rest = {b: ps for b, ps in hit.items() if b not in touched}
        if not rest:
            return touched
        held = self._read(old, rest)
        first = old.keys[0]
        if isinstance(held.schema[first].dataType, (IntegralType, StringType, DateType)):
            held = held.where(F.col(first).between(F.lit(facts["low"]), F.lit(facts["high"])))
        held = held.select(*old.keys, F.col("_metadata.file_path").alias("_file"))
        found = held.join(keys.select(*old.keys), old.keys, "left_semi").select("_file").distinct()
        for row in found.collect():
            write, bucket, name = row["_file"].split("/")[-3:]
            touched.setdefault(int(bucket.partition("=")[2]), []).append(f"{write[2:]}/{name}")
        return touched

    def _replace(
        self,
        old: Version,
        gone: dict[int, list[Part]],
        rows: DataFrame,
        together: bool = True,
        applied: dict[str, int] | None = None,
    ) -> None:
        """Write ``rows`` in place of the parts in ``gone``; all others are named again."""
        number = self._next(old)
        written = self._write(rows, number, old.keys, old.buckets, together)
        parts = dict(old.parts)
        for bucket, dropped in gone.items():
            whole = {p for p in dropped if isinstance(p, int)}
            split = {number_of(p) for p in dropped if isinstance(p, str)}
            kept: list[Part] = []
            for part in parts.pop(bucket):
                if isinstance(part, int) and part in split:
                    kept += [f for f in self._files(bucket, [part]) if f not in dropped]
                elif part not in whole and part not in dropped:
                    kept.append(part)
            if kept:
                parts[bucket] = kept
        for bucket in written:
            parts[bucket] = [*parts.get(bucket, []), number]
        marks = old.applied | (applied or {})
        self._commit(Version(number, old.schema, old.keys, old.buckets, parts, marks))

    def _partitions(self, version: Version) -> int | None:
        """A multiple of the bucket count, near the session's shuffle partitions."""
        usual = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return version.buckets * -(-usual // version.buckets)

    def _gathered(self, version: Version, batch: DataFrame, hit: Sequence[int]) -> DataFrame:
        """Rows of a batch of few keys, those of a bucket in one task and file."""
        if version.buckets == 1:
            return batch
        count = min(len(hit), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return batch.repartition(count, bucket_of(version.keys, version.buckets))

    def _facts(self, version: Version, batch: DataFrame, cdc_column: str | None = None) -> Row:
        """Rows, highest watermark, most copies of one key, key size, span and buckets of a batch.

        One job. The buckets are the only list, and there are ``version.buckets`` at most.
        """
        keys = version.keys
        bucket = bucket_of(keys, version.buckets) if version.buckets > 1 else F.lit(0)
        top = F.max(F.lit(None))
        if cdc_column:
            top = F.max(watermark_value(cdc_column, batch.schema[cdc_column].dataType))
        per_key = batch.groupBy(*keys).agg(F.count("*").alias("rows"), top.alias("top"))
        size = sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(8 * len(keys)))
        return per_key.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.sum(F.col("rows") * F.coalesce(size, F.lit(8))).alias("key_bytes"),
            F.max("top").alias("top"),
            F.max(F.when(~any_null(keys), F.col("rows"))).alias("copies"),
            F.min(keys[0]).alias("low"),
            F.max(keys[0]).alias("high"),
            F.collect_set(bucket).alias("hit"),
        ).first()

    @contextmanager
    def staging(self) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """A function that writes rows to the shared folder, for as long as the block runs.

        Every later step then sees the same rows, whatever happens to executors or
        to the source meanwhile.
        """
        folders: list[str] = []

        def stage(df: DataFrame) -> DataFrame:
            folders.append(fresh_folder(self.spark, "stage"))
            df.write.parquet(folders[-1])
            return self.spark.read.schema(df.schema).parquet(folders[-1])

        try:
            yield stage
        finally:
            for folder in folders:
                remove_folder(self.spark, folder)

    def merge_rows(self, rows: DataFrame, cdc_column: str | None = None) -> tuple[int, Any]:
        """Stage rows and merge them."""
        with self.staging() as stage:
            return self.merge(stage(rows), cdc_column)

    def delete_keys(self, doomed: DataFrame) -> None:
        """Stage keys and delete their rows."""
        with self.staging() as stage:
            self.delete(stage(doomed))

    def merge(
        self,
        staged: DataFrame,
        cdc_column: str | None = None,
        applied: dict[str, int] | None = None,
        newest_by: str | None = None,
    ) -> tuple[int, Any]:
        """MERGE staged rows by the table's keys; their number and highest ``cdc_column``.

        A batch with repeated keys is refused. An empty one writes no rows. ``applied``
        is added to what streams have brought, in the same commit. Rows with a lower
        ``newest_by`` than the target's row of their key stay out.

        The rewrite reads the touched files. A batch of few keys, by their measured size,
        is broadcast and leaves those rows where they are; a larger one costs one shuffle
        by key, whose partitions are written as they come.
        """
        with self._lock:
            old = self._require()
            batch = self._typed_keys(old, staged)
            facts = self._facts(old, batch, cdc_column)
            if (facts["copies"] or 0) > 1:
                raise DuplicateKeyError(f"{self.path}: batch repeats a key of {old.keys}")
            if hit := facts["hit"]:
                touched, partitions = self._touched(old, facts, self._few(facts, batch)), self._partitions(old)
                if newest_by:
                    same = [F.col(f"n.{k}") == F.col(f"o.{k}") for k in old.keys]
                    newer = F.col(f"o.{newest_by}") > F.col(f"n.{newest_by}")
                    held = self._read(old, touched).select(*old.keys, newest_by).alias("o")
                    batch = batch.alias("n").join(held, [*same, newer], "left_anti")
                if facts["key_bytes"] <= BROADCAST_KEY_BYTES:
                    batch, partitions = F.broadcast(self._gathered(old, batch, hit)), None
                rows = merge.merge_upsert(self._read(old, touched), batch, old.keys, partitions)
                self._replace(old, touched, rows, applied=applied)
            elif applied:
                self._commit(replace(old, number=self._next(old), applied=old.applied | applied))
            return facts["rows"], facts["top"]

    def delete(self, doomed: DataFrame) -> None:
        """Delete the rows of staged keys; keys that no file holds change nothing."""
        with self._lock:
            old = self._require()
            gone = self._typed_keys(old, doomed.select(*old.keys))
            facts = self._facts(old, gone)
            if not facts["hit"]:
                return
            gone, partitions = self._few(facts, gone), self._partitions(old)
            if touched := self._touched(old, facts, gone):
                if facts["key_bytes"] <= BROADCAST_KEY_BYTES:
                    partitions = None
                rows = merge.delete_by_keys(self._read(old, touched), gone, old.keys, partitions)
                self._replace(old, touched, rows)

    def apply(
        self,
        fetched: DataFrame,
        net: DataFrame,
        policy: str = "last_change",
        applied: dict[str, int] | None = None,
    ) -> None:
        """Apply staged net changes with the staged current rows of their upserted keys.

        ``applied`` is added to what streams have brought, in the same commit, also where
        no row changes.
        """
        with self._lock:
            old = self._require()
            net, fetched = self._typed_keys(old, net), self._typed_keys(old, fetched)
            facts = self._facts(old, net)
            touched = self._touched(old, facts, self._few(facts, net)) if facts["hit"] else {}
            if touched or not fetched.isEmpty():
                partitions = self._partitions(old)
                if facts["key_bytes"] <= BROADCAST_KEY_BYTES:
                    net, partitions = F.broadcast(net), None
                    fetched = self._gathered(old, fetched, facts["hit"])
                rows = merge.apply_fetched(
                    self._read(old, touched), fetched, net, old.keys, policy, partitions
                )
                self._replace(old, touched, rows, applied=applied)
            elif applied:
                self._commit(replace(old, number=self._next(old), applied=old.applied | applied))

    @staticmethod
    def _few(facts: Row, keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if facts["key_bytes"] <= BROADCAST_KEY_BYTES else keys

    @staticmethod
    def _typed_keys(version: Version, df: DataFrame) -> DataFrame:
        """Key columns in the table's types, so equal keys hash to equal buckets."""
        return df.withColumns({k: F.col(k).cast(version.schema[k].dataType) for k in version.keys})

    def truncate(self) -> None:
        with self._lock:
            old = self._require()
            self._commit(Version(self._next(old), old.schema, old.keys, old.buckets))

    def drop(self) -> None:
        """Remove the table if it is there."""
        with self._lock:
            self._folder.remove()

    def prune(self, keep: int = 2) -> None:
        """Remove version files before the newest ``keep``, and folders none of those names.

        Call it when no query that started before those versions is still running.
        """
        with self._lock:
            names = [n for n in self._versions.names() if n.endswith(".json") and n[0] != "."]
            kept = [Version.from_json(self._versions.read_text(n)) for n in names[-keep:]]
            named: dict[tuple[int, int], set[Part]] = {}
            for bucket, part in ((b, p) for k in kept for b, ps in k.parts.items() for p in ps):
                named.setdefault((bucket, number_of(part)), set()).add(part)
            for n in names[:-keep]:
                self._versions.remove(n)
            for folder in self._folder.names("data"):
                for child in self._folder.names(f"data/{folder}"):
                    if not child.startswith(f"{BUCKET}="):
                        continue
                    number, bucket = int(folder[2:]), int(child.partition("=")[2])
                    parts = named.get((bucket, number), set())
                    if not parts:
                        self._folder.remove(f"data/{folder}/{child}")
                    elif number not in parts:
                        for file in set(self._files(bucket, [number])) - parts:
                            self._folder.remove(f"data/{folder}/{child}/{file.partition('/')[2]}")


class Warehouse:
    """Target tables of one root folder, addressed by schema and table name."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._tables: dict[str, SnapshotTable] = {}
        self._lock = threading.Lock()

    def table(self, schema: str, name: str) -> SnapshotTable:
        path = f"{self.root}/{schema}/{name}"
        with self._lock:
            return self._tables.setdefault(path, SnapshotTable(self.spark, path))

    def schemas(self) -> list[str]:
        return Folder(self.spark, self.root).names()

    def tables(self, schema: str) -> list[str]:
        names = Folder(self.spark, f"{self.root}/{schema}").names()
        return [n for n in names if self.table(schema, n).exists()]
