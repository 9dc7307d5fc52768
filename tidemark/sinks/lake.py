"""Writers of the lake: one partitioned dataset per kind of row, read back by name.

The columns of each dataset are kept beside it, so one that is new, or whose files have all been archived or
purged, reads as no rows. Keyed datasets are merged when they are read: each load adds its own rows in its own
files, and of each key the newest row counts. So a load costs its own rows, a load that is repeated or a
compaction that stops half-way leaves nothing wrong, and no file another writer may read is replaced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.operators.dedup import new_rows
from tidemark.schema import TABLES, create_table_sql
from tidemark.session import apply_settings, pin

# Which run of a query or job wrote the rows, and in which of its batches.
BATCH = ("run", "batch_id")

# dataset -> partition columns; every report reads what is written here.
DATASETS: dict[str, tuple[str, ...]] = {
    "raw": ("date", "crypto_id", *BATCH),
    "prices": ("date",),
    "alerts": ("date", "crypto_id", "alert_type", *BATCH),
    "warehouse_prices": ("date",),
    "warehouse_alerts": ("date",),
    "alert_history": ("date", *BATCH),
    "aggregations": ("date", "hour", *BATCH),
    "partials": ("date", "hour", *BATCH),
    "event_keys": ("date", *BATCH),
    "sessions": ("date", *BATCH),
    "dead_letters": ("date", "step", *BATCH),
    "step_metrics": ("date", "step", *BATCH),
    "sla_metrics": ("date", "sla_id"),
    "audit": ("date",),
    "versions": ("date", "step"),
    "daily_summary": ("trade_date", *BATCH),
    "archive": ("date", "crypto_id", "archive_run"),
    "cache": ("expires_on", *BATCH),
    "reports": ("report", "date"),
}

# keyed dataset -> its key, with the partition columns that follow from it, so that a filter on them prunes.
KEYED: dict[str, tuple[str, ...]] = {
    "aggregations": ("crypto_id", "window_start", "date", "hour"),
    "daily_summary": ("crypto_id", "trade_date"),
    "cache": ("key",),
}
LOADED = "loaded_at"
DELETING_THREADS, DELETING_CHUNK = 16, 1024

# Types of partition columns; all others are text, so that an id like 007 stays as it is.
PARTITION_TYPES = {
    "date": DateType(), "trade_date": DateType(), "expires_on": DateType(), "hour": IntegerType(), "batch_id": LongType(),
}


def newest(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the row loaded last. Filters on the key reach the files."""
    order = Window.partitionBy(*keys).orderBy(F.desc(LOADED), F.desc("batch_id"), F.desc("run"))
    return stored.withColumn("_age", F.row_number().over(order)).filter("_age = 1").drop("_age")


@dataclass(frozen=True)
class Lake:
    """Datasets below one root folder."""

    spark: SparkSession
    root: str

    def path(self, dataset: str) -> str:
        if dataset not in DATASETS:
            raise KeyError(f"unknown dataset {dataset!r}")
        return f"{self.root}/{dataset}"

    def exists(self, dataset: str) -> bool:
        path = self._hadoop_path(self.path(dataset))
        return path.getFileSystem(self._hadoop_conf()).exists(path)

    def read(self, dataset: str, schema: StructType | None = None) -> DataFrame:
        """Rows of a dataset, of keyed ones the newest of each key. Types of partition columns are fixed."""
        stored = self.stored(dataset, schema)
        return newest(stored, KEYED[dataset]) if dataset in KEYED and LOADED in stored.columns else stored

    def stored(self, dataset: str, schema: StructType | None = None) -> DataFrame:
        """All rows of a dataset; none of one that was never written or has been emptied."""
        path = self.path(dataset)
        schema = schema or self._known_schema(dataset)
        there = self.exists(dataset)
        if schema is None and there:
            found = self.spark.read.option("mergeSchema", "false").parquet(path).schema
            schema = self._typed(dataset, found)
        if schema is None:
            schema = self._typed(dataset, StructType([StructField(c, StringType()) for c in DATASETS[dataset]]))
        return self.spark.read.schema(schema).parquet(path) if there else self.spark.createDataFrame([], schema)

    def placed(self, dataset: str) -> DataFrame:
        """All rows of a dataset with the file each is in."""
        rows = self.stored(dataset)
        file = F.col("_metadata.file_path") if self.exists(dataset) else F.lit(None).cast("string")
        return rows.select("*", file.alias("source_file"))

    def _typed(self, dataset: str, schema: StructType) -> StructType:
        """Partition columns in their fixed types; text where none is given, so that an id like 007 stays as it is."""
        typed = {c: PARTITION_TYPES.get(c, StringType()) for c in DATASETS[dataset]}
        return StructType([StructField(f.name, typed.get(f.name, f.dataType)) for f in schema])

    def _schema_folder(self, dataset: str) -> str:
        return f"{self.root}/schemas/{dataset}"

    def _known_schema(self, dataset: str) -> StructType | None:
        """The columns of all rows ever written, in the order in which they came."""
        names = sorted(self._names(self._schema_folder(dataset)))
        fields: dict[str, StructField] = {}
        for name in names:
            text = self.spark.read.text(f"{self._schema_folder(dataset)}/{name}", wholetext=True).first()[0]
            for f in StructType.fromJson(json.loads(text)):
                fields.setdefault(f.name, f)
        return StructType(list(fields.values())) if names else None

    def _remember_schema(self, dataset: str, schema: StructType) -> None:
        """Keep the columns, as one file for each new set of columns; files are never changed."""
        typed = self._typed(dataset, schema)
        known = self._known_schema(dataset)
        if known is not None and {f.name for f in typed} <= {f.name for f in known}:
            return
        name = f"{0 if known is None else len(known):06d}-{uuid.uuid4().hex}.json"
        target = self._hadoop_path(f"{self._schema_folder(dataset)}/{name}")
        out = target.getFileSystem(self._hadoop_conf()).create(target, True)
        out.write(bytearray(json.dumps(typed.jsonValue()).encode()))
        out.close()

    def write(self, df: DataFrame, dataset: str, mode: str = "append") -> None:
        """Write rows to their partitions.

        The rebalance hint gathers each partition into few files and splits a partition that is
        much larger than the others, so a hot asset is not written by one task. Datasets that are
        written by batch take these rows as the only batch of a new run.
        """
        apply_settings(self.spark)
        columns = DATASETS[dataset]
        if "batch_id" in columns:
            if mode != "append":
                raise ValueError(f"{dataset} is written by run and batch and is only appended to")
            return self.write_batch(df, dataset, 0, uuid.uuid4().hex)
        self._remember_schema(dataset, df.schema)
        shaped = df.hint("rebalance", *[F.col(c) for c in columns])
        shaped.write.mode(mode).partitionBy(*columns).parquet(self.path(dataset))

    def write_batch(self, df: DataFrame, dataset: str, batch_id: int, run: str) -> None:
        """Write a micro-batch so that writing it again replaces it and nothing else.

        The folder is named by the run, which a query keeps in its checkpoint, and the batch.
        """
        apply_settings(self.spark)
        columns = DATASETS[dataset]
        if "batch_id" not in columns:
            raise ValueError(f"{dataset} is not written by batch")
        marked = df.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
        if dataset in KEYED and LOADED not in df.columns:
            marked = marked.withColumn(LOADED, F.lit(self.batch_time(run, batch_id)))
        self._remember_schema(dataset, marked.schema)
        shaped = marked.hint("rebalance", *[F.col(c) for c in columns])
        shaped.write.mode("overwrite").partitionBy(*columns).parquet(self.path(dataset))

    def run_of(self, checkpoint: str) -> str:
        """The name of the run that a checkpoint belongs to; a new checkpoint gets a new one."""
        folder = f"{checkpoint}/tidemark"
        names = self._names(folder)
        if not names:
            names = [uuid.uuid4().hex]
            self._touch(f"{folder}/{names[0]}")
        return names[0]

    def batch_time(self, run: str, batch_id: int) -> datetime:
        """When the batch was first begun; the same for every later try. Earlier marks are dropped."""
        folder = f"{self.root}/batch_times/{run}"
        mark = self._hadoop_path(f"{folder}/{batch_id}")
        fs = mark.getFileSystem(self._hadoop_conf())
        fs.createNewFile(mark)
        self._delete(f"{folder}/{batch_id - 2}")
        return datetime.fromtimestamp(fs.getFileStatus(mark).getModificationTime() / 1000, timezone.utc)

    def report(self, df: DataFrame, name: str, date: str, mode: str = "overwrite") -> None:
        """One report of one day as JSON; a later run of the same day replaces it."""
        folder = f"{self.path('reports')}/report={name}/date={date}"
        df.write.mode(mode).json(folder)

    def report_history(self, name: str, last: str, days: int, schema: StructType) -> DataFrame:
        """A report of the last `days` days, with its date; days without one are just missing."""
        end = F.lit(last).cast("date")
        full = StructType([*schema, StructField("report", StringType()), StructField("date", DateType())])
        return (
            self.spark.read.schema(full)
            .json(self.path("reports"))
            .filter((F.col("report") == name) & (F.col("date") > F.date_sub(end, days)) & (F.col("date") <= end))
            .drop("report")
        )

    def insert_if_absent(self, incoming: DataFrame, dataset: str, keys: Sequence[str], arrival: str) -> int:
        """Append the rows whose key is new, and return their number.

        Of the target only the key columns are read, of the days that come in; a day in between is not.
        """
        known = self.matching(incoming, dataset, keys)
        added = pin(new_rows(incoming, known, keys, arrival).drop(arrival))
        self.write(added, dataset)
        return added.count()

    def matching(
        self, incoming: DataFrame, dataset: str, keys: Sequence[str], run: str | None = None, batch_id: int = 0
    ) -> DataFrame:
        """The keys of `incoming` that a dataset by `date` has already.

        A batch that is repeated does not see what it wrote itself before. Days are pruned by a join with those that
        come in, at run time; the other side of the key join is the incoming keys, small beside the target.
        """
        schema = incoming.select(*keys, "date").schema
        if dataset in self._batched():
            schema = StructType([*schema, *[StructField(c, PARTITION_TYPES.get(c, StringType())) for c in BATCH]])
        stored = self.stored(dataset, schema)
        if run is not None:
            stored = stored.filter((F.col("run") != run) | (F.col("batch_id") < batch_id))
        # One row per day. The comparison only tells the optimizer that the days are a selection.
        days = incoming.filter(F.col("date") > F.lit("0001-01-01").cast("date")).select("date").distinct()
        wanted = incoming.select(*keys, "date").distinct()
        return (
            stored.join(F.broadcast(days), "date", "left_semi").join(wanted, [*keys, "date"], "left_semi").select(*keys)
        )

    def _batched(self) -> set[str]:
        return {name for name, columns in DATASETS.items() if "batch_id" in columns}

    def upsert(
        self, changes: DataFrame, dataset: str, keys: Sequence[str], batch_id: int = 0, run: str | None = None
    ) -> None:
        """Replace rows by key: the changes are added, and the newest row of a key is the one that is read.

        A micro-batch writes its own rows and reads nothing. `compact` puts the rows together from time to time.
        """
        if not set(keys) <= set(KEYED.get(dataset, ())):
            raise ValueError(f"{dataset} is not keyed by {', '.join(keys)}")
        self.write_batch(changes, dataset, batch_id, run or uuid.uuid4().hex)

    def compact(self, dataset: str) -> int:
        """Rewrite the partitions of a keyed dataset that have several files, one row per key; files taken away.

        The copies keep their load time, so until the old files are gone, and if they stay because the run
        stopped, readers see each key once. Loads that land meanwhile are in files of their own.
        """
        columns = [c for c in DATASETS[dataset] if c not in BATCH]
        placed = self.placed(dataset)
        several = placed.groupBy(*columns).agg(F.count_distinct("source_file").alias("_files")).filter("_files > 1")
        several = pin(several.drop("_files"))
        old = placed.join(several, columns, "left_semi")
        gone = pin(old.select("source_file").distinct())
        # A key may have moved to another partition: its newest row is looked for in the whole dataset.
        kept = newest(placed, KEYED[dataset]).join(several, columns, "left_semi").drop("source_file", *BATCH)
        if not several.isEmpty():
            self.write_batch(pin(kept), dataset, 0, f"compacted-{uuid.uuid4().hex}")
        self._delete_files(gone)
        return gone.count()

    def archive(self, before: str, dataset: str = "raw", target: str = "archive") -> DataFrame:
        """Move the days before a date to the archive and return the rows moved per day.

        Copy, mark as copied, then delete the files that were copied, whose names the copies carry. A run
        that stopped is taken up again under its own name: before the mark it copies anew, after it
        it only deletes, so no row is lost or doubled. Rows that arrive meanwhile or later for an
        archived day are in other files and go to a later run.
        """
        state = f"{self.root}/{target}_state"
        run, copied = self._open_run(state)
        placed = self.placed(dataset)
        old = placed.filter(F.col("date") < F.lit(before).cast("date")).withColumn("archive_run", F.lit(run))
        if not copied:
            self.write(old, target, "overwrite")
            self._touch(f"{state}/{run}.copied")
        mine = self.read(target, old.schema).filter(F.col("archive_run") == run)
        moved = pin(mine.groupBy("date").agg(F.count(F.lit(1)).alias("rows_moved")))
        self._delete_files(mine)
        self._delete(state)
        return moved

    def purge_expired(self, as_of: str) -> int:
        """Drop expired cache rows, and rows a later one of their key replaced; return the number of expired ones.

        Only files that hold such rows are touched: their other rows are written anew before those files go, with their
        load time, so that rows which land meanwhile stay and a run that stops in between leaves each key once.
        """
        entries = self.placed("cache")
        if LOADED not in entries.columns:
            return 0
        now = F.lit(as_of).cast(entries.schema["expires_at"].dataType)
        same_key = Window.partitionBy(*KEYED["cache"]).orderBy(
            F.desc(LOADED), F.desc("batch_id"), F.desc("run"), F.desc("source_file")
        )
        ranked = pin(
            entries.withColumn("_stale", F.row_number().over(same_key) > 1)
            .withColumn("_expired", F.coalesce(F.col("expires_at") < now, F.lit(False)))
        )
        spent = F.col("_stale") | F.col("_expired")
        gone = pin(
            ranked.filter(spent).groupBy("source_file").agg(F.count_if(~F.col("_stale")).alias("n"))
        )
        total = gone.agg(F.sum("n")).first()[0] or 0
        kept = ranked.filter(~spent).join(gone, "source_file", "left_semi")
        kept = pin(kept.drop("source_file", "_stale", "_expired", *BATCH))
        if not kept.isEmpty():
            self.write_batch(kept, "cache", 0, uuid.uuid4().hex)
        self._delete_files(gone)
        return total

    def _open_run(self, state: str) -> tuple[str, bool]:
        """The unfinished run named in the state folder, or a new one; and whether it has copied."""
        names = self._names(state)
        if names:
            run = names[0].split(".")[0]
            return run, f"{run}.copied" in names
        run = uuid.uuid4().hex
        self._touch(f"{state}/{run}.started")
        return run, False

    def _names(self, path: str) -> list[str]:
        folder = self._hadoop_path(path)
        fs = folder.getFileSystem(self._hadoop_conf())
        return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []

    def _delete_files(self, rows: DataFrame) -> None:
        """Delete the files named in `source_file`, many at a time; the names come partition by partition."""
        jvm = self.spark.sparkContext._jvm

        def delete(name: str) -> None:
            self._delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).toString())

        names = (r[0] for r in rows.select("source_file").distinct().toLocalIterator())
        with ThreadPoolExecutor(DELETING_THREADS) as pool:
            while chunk := list(islice(names, DELETING_CHUNK)):
                list(pool.map(delete, chunk))

    def _touch(self, path: str) -> None:
        target = self._hadoop_path(path)
        target.getFileSystem(self._hadoop_conf()).create(target, True).close()

    def _hadoop_conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _delete(self, path: str) -> None:
        target = self._hadoop_path(path)
        target.getFileSystem(self._hadoop_conf()).delete(target, True)


def jdbc_options(url: str, table: str, batch_rows: int = 100, connections: int = 8, **extra: str) -> dict:
    """Options of a batched table insert with a bound on parallel connections."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        **extra,
    }


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()


def stored_prices(events: DataFrame, ingested_at, *more: str) -> DataFrame:
    """Validated events in the column types of the price table, and the columns named."""
    return events.select(
        "crypto_id",
        F.col("price_usd").cast("decimal(20,8)").alias("price_usd"),
        F.col("market_cap_usd").cast("decimal(30,2)").alias("market_cap_usd"),
        F.col("change_24h_pct").cast("decimal(10,4)").alias("change_24h_pct"),
        "event_timestamp",
        "source",
        ingested_at.alias("ingested_at"),
        F.to_date("event_timestamp").alias("date"),
        *more,
    )


def create_tables(spark: SparkSession, database: str | None = None) -> None:
    """The three operational and three warehouse tables."""
    for name in TABLES:
        spark.sql(create_table_sql(name, database))
