"""Keyed tables: current state under a primary key, on plain Parquet.

The merge functions take the current rows and the changes as DataFrames. ``KeyedTable`` keeps the state of one table:
a compacted base with one row per key and, beside it, the changes of every batch since. A batch costs a write of its own
rows, whatever the size of the table; reading lets the latest change of a key hide its base row; ``compact`` folds the
changes in. A batch always writes the same folder, so a replay after a failure replaces what the first attempt left,
and only folders that Spark has marked as complete are read. Several feeds and jobs may write a table in turn.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayline.operators.cdc import ORDER, ORDER_TYPE, check_operations, last_change
from quayline.session import finished_folders, remove_folder

FEED, BATCH, ARRIVAL, BASE = "_feed", "_batch", "_arrival", "_base"  # name the folders, and with them columns of the changes
PLACE = "_place"  # a row's place in the order of events


def merge(target: DataFrame, changes: DataFrame, key: str = "id", op: str = "op_type",
          order: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """The state after ``changes``: deletes remove a row, inserts and updates put theirs in its place.

    With ``order`` a key may change several times, else it may change once. ``strict`` lets an update touch only a row
    that is there, in the target or by an earlier insert of the same batch.
    """
    changes = check_operations(changes, op)
    if strict:
        sequence = F.struct(*order) if order else F.lit(1)
        decisive = changes.where(F.col(op) != "update").groupBy(key).agg(
            F.max_by(op, sequence).alias("_decisive"))
    if order:
        changes = last_change(changes, key, order)
    rows = changes.where(F.col(op) != "delete").select(target.columns)
    if strict:
        there = (changes.select(key).join(decisive, key, "left")
                 .join(target.select(key, F.lit(True).alias("_there")), key, "left")
                 .where(F.when(F.col("_decisive").isNull(), F.col("_there"))
                        .otherwise(F.col("_decisive") == "insert"))
                 .select(key))
        rows = rows.join(there, key, "left_semi")
    return target.join(changes.select(key), key, "left_anti").select(target.columns).unionByName(rows)


def insert_only(target: DataFrame, rows: DataFrame, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """Add the rows whose key is new. Of several with one key the last in ``order`` counts, of equals the greatest."""
    new = last_change(rows, key, order).join(target.select(key), key, "left_anti")
    return target.unionByName(new.select(target.columns))


def update_only(target: DataFrame, rows: DataFrame, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """Replace the rows whose key exists. Of several with one key the last in ``order`` counts, of equals the greatest."""
    rows = last_change(rows, key, order)
    known = rows.join(target.select(key), key, "left_semi").select(target.columns)
    return target.join(rows.select(key), key, "left_anti").select(target.columns).unionByName(known)


def delete_keys(target: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """Remove the rows whose key is listed."""
    return target.join(keys.select(key), key, "left_anti").select(target.columns)


def delete_report(target: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """How many of the listed keys were there to delete and how many were not."""
    return (keys.select(key).distinct()
            .join(target.select(key, F.lit(True).alias("_there")), key, "left")
            .agg(F.count("_there").alias("found"), F.count_if(F.col("_there").isNull()).alias("not_found")))


def update_columns(target: DataFrame, patch: DataFrame, columns: Sequence[str], key: str = "id",
                   order: Sequence[str] = ()) -> DataFrame:
    """Overwrite some columns of the rows whose key is in ``patch``; of several patches of a key the last in ``order``
    counts, of equals the greatest."""
    patch = last_change(patch.select(*dict.fromkeys([key, *order, *columns])), key, order)
    patch = patch.select(key, F.lit(True).alias("_patched"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(patch, key, "left")
    return joined.select([
        F.when(F.col("_patched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns])


def update_where(target: DataFrame, predicate: Column, values: Mapping[str, Column]) -> DataFrame:
    """Update by query: set columns of the rows that fulfil ``predicate``."""
    return target.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in values.items()})


def merge_into(changes: DataFrame, table: str, key: str = "id", op: str = "op_type") -> None:
    """The same merge done by the catalog, where its tables support ``MERGE INTO``."""
    values = {c: F.col(f"changes.{c}") for c in changes.columns if c != op}
    (changes.alias("changes").mergeInto(table, F.expr(f"{table}.{key} = changes.{key}"))
     .whenMatched(F.col(f"changes.{op}") == "delete").delete()
     .whenMatched().update(values)
     .whenNotMatched(F.col(f"changes.{op}") != "delete").insert(values)
     .merge())


def create_table_ddl(name: str, schema: T.StructType, keys: Sequence[str] = ("id",), buckets: int = 3,
                     provider: str = "parquet", path: str | None = None) -> str:
    """DDL of a catalog table for a schema: keys first and NOT NULL, hashed on the keys into buckets; ``path`` says where."""
    ordered = sorted(schema.fields, key=lambda f: list(keys).index(f.name) if f.name in keys else len(keys))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{' NOT NULL' if f.name in keys else ''}"
                        for f in ordered)
    by = ", ".join(f"`{k}`" for k in keys)
    return (f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider} "
            f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS" + (f" LOCATION '{path}'" if path else ""))


def create_table(spark: SparkSession, name: str, schema: T.StructType, keys: Sequence[str] = ("id",), buckets: int = 3,
                 provider: str = "parquet", path: str | None = None) -> DataFrame:
    """The catalog table of that name, made first if it is not there."""
    spark.sql(create_table_ddl(name, schema, keys, buckets, provider, path))
    return spark.table(name)


class KeyedTable:
    """The current state of one table under a folder.

    Every writer, a streaming query or a job, has a name, its *feed*, and numbers its own batches. A batch also gets a
    number of arrival over all feeds, which its rows carry: of two changes of a key the one that arrived later counts, and
    inside a batch the one that is later in ``order``. A base lists the last batch of each feed that it holds.

    With ``by_event`` the event order decides across batches too: rows and deletes are stored with their place in it
    (``ORDER``), so an event that comes late can't undo a newer one. A deleted key then stays as a mark until a compaction
    is told to forget it; rows without a place, such as a full load, are older than any event.

    Changes lie in the generation of the base they follow. A compaction begins a new generation; only the last two are ever
    listed, so that what another writer adds meanwhile is seen, and listings don't grow with the table's age.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "id",
                 partition_by: Sequence[str] = (), by_event: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.key = key
        self.partition_by = list(partition_by)
        self.by_event = by_event

    def _generations(self) -> list[int]:
        """The last two bases, 0 standing for none."""
        return ([0] + sorted(int(f.rsplit("=", 1)[1]) for f in finished_folders(self.spark, f"{self.path}/base/{ARRIVAL}=*")))[-2:]

    def _changes(self, generations: Sequence[int]) -> list[tuple[int, str, int, str]]:
        """Arrival, feed, batch and folder of every complete batch."""
        own = ",".join(map(str, generations))
        found = finished_folders(self.spark, f"{self.path}/changes/{BASE}={{{own}}}/{FEED}=*/{BATCH}=*/{ARRIVAL}=*")
        parts = [(f, dict(p.split("=", 1) for p in f.split("/")[-3:])) for f in found]
        return sorted((int(p[ARRIVAL]), p[FEED], int(p[BATCH]), f) for f, p in parts)

    def _held(self, base: int) -> dict[str, int]:
        """The last batch of each feed in a base; a row a feed."""
        if not base:
            return {}
        rows = self.spark.read.schema("feed string, batch long").parquet(f"{self.path}/held/{ARRIVAL}={base}").collect()
        return {r["feed"]: r["batch"] for r in rows}

    def _write(self, df: DataFrame, folder: str) -> None:
        if self.partition_by:
            # Even files per partition value; adaptive execution splits a value that holds most of the rows.
            df = df.hint("rebalance", *self.partition_by)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *self.partition_by).parquet(folder)
        if not finished_folders(self.spark, folder):
            raise RuntimeError(f"{folder} was written without a success marker, so it would not be read")

    def _write_base(self, rows: DataFrame, arrival: int, held: Mapping[str, int]) -> None:
        (self.spark.createDataFrame(list(held.items()), "feed string, batch long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/held/{ARRIVAL}={arrival}"))
        self._write(rows, f"{self.path}/base/{ARRIVAL}={arrival}")

    def _stored_type(self) -> T.StructType:
        extra = [T.StructField(PLACE, ORDER_TYPE), T.StructField("op_type", T.StringType())] if self.by_event else []
        return T.StructType([*self.schema.fields, *extra])

    def feed_batches(self, feed: str) -> list[int]:
        """The numbers of a feed's batches that can still be told apart, the last one among them."""
        generations = self._generations()
        held = self._held(generations[-1])
        return sorted({b for _, f, b, _ in self._changes(generations) if f == feed} | ({held[feed]} if feed in held else set()))

    def apply(self, changes: DataFrame, batch: int, order: Sequence[str] | None = ORDER, feed: str = "main") -> None:
        """Record the changes of a feed's batch. ``order=None`` says that no key changes twice in it.

        The newest batch of a feed may be repeated, which replaces what the first attempt left; an older one raises.
        """
        if not re.fullmatch(r"[\w.-]+", feed):
            raise ValueError(f"not a name for a feed: {feed!r}")
        generations = self._generations()
        held, known = self._held(generations[-1]), self._changes(generations)
        own = {b: (a, folder) for a, f, b, folder in known if f == feed}
        last = max([*own, held.get(feed, -1)])
        if batch < last:
            raise ValueError(f"batch {batch} of feed {feed} after its batch {last}: another checkpoint needs another feed")
        if batch == held.get(feed):
            return  # the base holds it
        changes = check_operations(changes)
        if order:
            changes = last_change(changes, self.key, order)
        if self.by_event:
            changes = changes.withColumn(PLACE, _place(changes))
        arrival = 1 + max([a for a, *_ in known] + generations)
        folder = f"{self.path}/changes/{BASE}={generations[-1]}/{FEED}={feed}/{BATCH}={batch}/{ARRIVAL}={arrival}"
        names = [*self.schema.names, *([PLACE] if self.by_event else []), "op_type"]
        self._write(changes.select(names), own[batch][1] if batch in own else folder)

    def upsert(self, rows: DataFrame, feed: str = "upsert", order: Sequence[str] = (), unique: bool = False) -> None:
        """Record rows as the feed's next batch. Of several with one key the last in ``order`` counts, of equals the
        greatest; ``unique`` says that there are none."""
        if not unique:
            rows = last_change(rows, self.key, order)
        self.apply(rows.withColumn("op_type", F.lit("update")), max(self.feed_batches(feed), default=-1) + 1,
                   order=None, feed=feed)

    def replace(self, rows: DataFrame, order: Sequence[str] = (), unique: bool = False) -> None:
        """Make ``rows`` the whole table; what arrived before is gone, what arrives later counts. Keys as in ``upsert``."""
        generations = self._generations()
        known = self._changes(generations)
        held = self._held(generations[-1]) | {f: b for _, f, b, _ in known}  # a feed's batches arrive in order
        if not unique:
            rows = last_change(rows, self.key, order)
        if self.by_event:
            rows = rows.withColumn(PLACE, _place(rows)).withColumn("op_type", F.lit("update"))
        self._write_base(rows.select(self._stored_type().names), 1 + max([a for a, *_ in known] + generations), held)

    def _pending(self, generations: Sequence[int]) -> list[tuple[int, str, int, str]]:
        held = self._held(generations[-1])
        return [c for c in self._changes(generations) if c[2] > held.get(c[1], -1)]

    def pending(self) -> int:
        """How many batches a compaction would fold in."""
        return len(self._pending(self._generations()))

    def _read_changes(self, folders: Sequence[str]) -> DataFrame:
        place = [T.StructField(PLACE, ORDER_TYPE)] if self.by_event else []
        read = T.StructType([*self.schema.fields, *place, T.StructField("op_type", T.StringType()),
                             T.StructField(FEED, T.StringType()), T.StructField(ARRIVAL, T.LongType())])
        rows = self.spark.read.schema(read).option("basePath", f"{self.path}/changes").parquet(*folders)
        return rows.select(read.names)

    def changes_of(self, feed: str, batch: int) -> DataFrame:
        """The recorded changes of a feed's batch; none where a base holds them already."""
        folders = [folder for _, f, b, folder in self._changes(self._generations()) if (f, b) == (feed, batch)]
        names = [*self.schema.names, "op_type"]
        if folders:
            return self._read_changes(folders).select(names)
        return self.spark.createDataFrame([], self.schema).withColumn("op_type", F.lit(""))

    def _state(self, base: int, pending: Sequence[tuple[int, str, int, str]], parts: DataFrame | None = None) -> DataFrame:
        """The rows, with ``by_event`` also the marks of deleted ones."""
        names = self._stored_type().names
        rows = (self.spark.read.schema(self._stored_type()).parquet(f"{self.path}/base/{ARRIVAL}={base}").select(names)
                if base else self.spark.createDataFrame([], self._stored_type()))
        if parts is not None:
            rows = rows.join(parts, parts.columns, "left_semi")
        if not pending:
            return rows
        changes = self._read_changes([folder for *_, folder in pending])
        if self.by_event:
            keys = changes.select(self.key).distinct()
            older = rows.join(keys, self.key, "left_semi").withColumns({
                FEED: F.lit(None).cast("string"), ARRIVAL: F.lit(0).cast("long")})
            latest = last_change(changes.unionByName(older), self.key, [PLACE, ARRIVAL, FEED]).select(names)
            return rows.join(keys, self.key, "left_anti").select(names).unionByName(latest)
        if len(pending) > 1:
            changes = last_change(changes, self.key, [ARRIVAL, FEED])
        if not base:
            changes = changes.where(F.col("op_type") != "delete").select(self.schema.names)
            return changes if parts is None else changes.join(parts, parts.columns, "left_semi")
        merged = merge(rows, changes.select(*self.schema.names, "op_type"), self.key)
        return merged if parts is None else merged.join(parts, parts.columns, "left_semi")

    def snapshot(self, parts: DataFrame | None = None) -> DataFrame:
        """The current rows. ``parts`` asks only for those that have its values in its columns, which the key must decide: a row
        that changed them would not be seen. Where they partition the table, only their folders of the base are read."""
        generations = self._generations()
        rows = self._state(generations[-1], self._pending(generations), parts)
        return rows.where(F.col("op_type") != "delete").select(self.schema.names) if self.by_event else rows

    def compact(self, forget_before: str | None = None) -> None:
        """Fold all recorded changes into a new base. It rewrites the table: use ``merge_into`` where a catalog has it.

        With ``by_event`` the marks of keys deleted before the event time ``forget_before`` go; later events must not be
        older than that.
        """
        generations = self._generations()
        pending = self._pending(generations)
        if pending:
            held = self._held(generations[-1]) | {f: b for _, f, b, _ in pending}
            rows = self._state(generations[-1], pending)
            if self.by_event and forget_before is not None:
                rows = rows.where(~((F.col("op_type") == "delete") & (F.coalesce(F.col(PLACE)["event_time"], F.lit("")) < forget_before)))
            self._write_base(rows, 1 + max([a for a, *_ in pending] + generations), held)

    def vacuum(self) -> None:
        """Remove generations before the last two. Frames made from them can't be read any more."""
        kept = self._generations()
        bases = [int(f.rsplit("=", 1)[1]) for f in finished_folders(self.spark, f"{self.path}/base/{ARRIVAL}=*")]
        for base in [0, *bases]:
            if base < min(kept):
                for folder in (f"base/{ARRIVAL}={base}", f"held/{ARRIVAL}={base}", f"changes/{BASE}={base}"):
                    remove_folder(self.spark, f"{self.path}/{folder}")


def _place(rows: DataFrame) -> Column:
    """A row's place in the order of events; columns that are not there count as NULL."""
    fields = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDER_TYPE]
    return F.struct(*fields)
