"""Tables of a stream with a row per key, which cost a batch what the batch touches.

A table lies in folders bucket=b/batch_id=n: a key's bucket is a hash of it, and each batch writes the keys that it has changed.
The newest row of a key counts. Folders of one bucket are merged when the newer ones have grown as large as the older one before
them, so a bucket of any age has few folders, a row is written again about as often as the table has doubled since, and a bucket
that is not touched is never written. Everything is keyed by the batch: a repeated batch replaces its own folders.
"""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagpulse.streaming.folders import files_of, latest, numbered_folders

BUCKETS = 16
BUCKET, BATCH = "bucket", "batch_id"
SETTLED = 2  # the last batch may be repeated; it and the one before it are never merged
GRACE = 8  # merged folders stay for so many batches, for readers that have listed them


def bucket_of(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class KeyedTable:
    """The table at `path` with the columns of `schema`, one row for each value of `keys`."""

    def __init__(self, spark: SparkSession, path: str, keys, schema, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, str(path), list(keys), buckets
        schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.columns = schema.fieldNames()
        self.schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.LongType())])

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of `rows`: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(bucket_of(self.keys, self.buckets).alias(BUCKET)).distinct().collect())

    def read(self, buckets=None, before: int | None = None) -> DataFrame:
        """The newest row of each key in these buckets (all, if not given), as it was before a batch (now, if not given)."""
        there = numbered_folders(self.spark, self.path, BUCKET)
        paths = [there[b] for b in (there if buckets is None else buckets) if b in there]
        if not paths:
            return self._empty()
        log = self.spark.read.option("basePath", self.path).schema(self.schema).parquet(*paths)
        gone = sorted(self._retired())
        if gone:  # what they say is in newer folders; they may go while this is read
            log = log.where(~F.concat_ws("/", BUCKET, BATCH).isin(gone))
        if before is not None:
            log = log.where(F.col(BATCH) < before)
        return latest(log.drop(BUCKET), self.keys).select(*self.columns)

    def lookup(self, rows: DataFrame, before: int | None = None, buckets=None) -> DataFrame:
        """The rows of the keys in `rows`; only their buckets are read."""
        buckets = self.touched(rows) if buckets is None else buckets
        return self.read(buckets, before).join(rows.select(*self.keys).distinct(), self.keys, "left_semi")

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Writes the batch's rows of changed keys, and returns them read back: later steps do not compute them again."""
        placed = rows.select(*self.columns).withColumns({BUCKET: bucket_of(self.keys, self.buckets), BATCH: F.lit(batch_id).cast("long")})
        self._append(placed, "overwrite")
        files, pattern = files_of(self.spark, f"{self.path}/{BUCKET}=*/{BATCH}={batch_id}")
        if not len(files.globStatus(pattern) or []):
            return self._empty()
        return self.spark.read.option("basePath", self.path).schema(self.schema).parquet(pattern.toString()).select(*self.columns)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType(self.schema.fields[:-2]))

    def _append(self, placed: DataFrame, mode: str) -> None:
        (placed.repartition(BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET, BATCH).parquet(self.path))

    def compact(self, batch_id: int) -> None:
        """Merges what there is to merge, in one job, and removes what was merged some batches ago. Buckets without new rows are
        listed, no more.

        The newest merged folder gets the newest rows of keys that it lacks. Done twice, or broken off at any place, it changes
        nothing that `read` shows.
        """
        self._clear(batch_id)
        retired = self._retired()
        merges = {}
        for bucket, path in numbered_folders(self.spark, self.path, BUCKET).items():
            folders = numbered_folders(self.spark, path, BATCH)
            settled = [n for n in sorted(folders) if n <= batch_id - SETTLED and f"{bucket}/{n}" not in retired]
            chosen = self._run(settled, {n: _size(self.spark, folders[n]) for n in settled})
            if len(chosen) > 1:
                merges[bucket] = chosen
        if not merges:
            return
        paths = [f"{self.path}/{BUCKET}={b}/{BATCH}={n}" for b, chosen in merges.items() for n in chosen]
        log = self.spark.read.option("basePath", self.path).schema(self.schema).parquet(*paths)
        target = F.create_map(*[F.lit(x) for b, chosen in merges.items() for x in (b, chosen[-1])])
        newest = latest(log, [*self.keys, BUCKET]).withColumn("_to", target[F.col(BUCKET)].cast("long"))
        moved = newest.where(F.col(BATCH) < F.col("_to")).withColumn(BATCH, F.col("_to")).select(*self.columns, BUCKET, BATCH)
        self._append(moved, "append")
        self._retire(batch_id, [f"{b}/{n}" for b, chosen in merges.items() for n in chosen[:-1]])

    @staticmethod
    def _run(numbers: list[int], sizes: dict[int, int]) -> list[int]:
        """The newest folders, back to the oldest that is not larger than all after it together."""
        chosen, total = 0, 0
        for back, n in enumerate(reversed(numbers), 1):
            if sizes[n] <= total:
                chosen = back
            total += sizes[n]
        return numbers[len(numbers) - chosen:]

    def _retire(self, batch_id: int, folders: list[str]) -> None:
        """Notes folders (bucket/batch) that are merged, so that they are not read any more."""
        files, note = files_of(self.spark, f"{self.path}/_retired/{batch_id}.json")
        stream = files.create(note, True)
        try:
            stream.write(bytearray(json.dumps(folders).encode()))
        finally:
            stream.close()

    def _notes(self):
        """The batch, place and content of every note."""
        files, folder = files_of(self.spark, f"{self.path}/_retired")
        for status in files.listStatus(folder) if files.exists(folder) else []:
            stream = files.open(status.getPath())
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            yield int(status.getPath().getName().split(".")[0]), status.getPath(), json.loads(text or "[]")

    def _retired(self) -> set[str]:
        return {folder for _, _, folders in self._notes() for folder in folders}

    def _clear(self, batch_id: int) -> None:
        """Removes what was merged some batches ago, and then the note of it."""
        for number, note, folders in self._notes():
            if number + GRACE <= batch_id:
                for folder in folders:
                    bucket, batch = folder.split("/")
                    files, at = files_of(self.spark, f"{self.path}/{BUCKET}={bucket}/{BATCH}={batch}")
                    files.delete(at, True)
                files.delete(note, False)


def _size(spark: SparkSession, path: str) -> int:
    files, at = files_of(spark, path)
    return files.getContentSummary(at).getLength()


class Record:
    """A recorded result indexed by key: written once under `path`, read by the buckets of the keys that a batch touches.

    With parts, the row of part 0 knows how many further ones there are.
    """

    def __init__(self, recorded: DataFrame, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = recorded.sparkSession, str(path), key, buckets
        self.columns = recorded.columns
        last = T.StructField("_last", T.LongType())
        self.schema = T.StructType([*recorded.schema.fields, last, T.StructField(BUCKET, T.IntegerType())])
        files, done = files_of(self.spark, f"{self.path}/_SUCCESS")
        if not files.exists(done):
            known = recorded.withColumn("_last", F.lit(None).cast("long"))
            if "part" in self.columns:
                ends = recorded.groupBy(key).agg(F.max("part").cast("long").alias("_last")).withColumn("part", F.lit(0).cast("long"))
                known = recorded.join(ends, [key, "part"], "left")
            known = known.withColumn(BUCKET, bucket_of([key], buckets)).repartition(BUCKET)
            known.write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def lookup(self, rows: DataFrame, buckets=None) -> DataFrame:
        """The record of the keys in `rows`, with `_last` at part 0; only their buckets are read."""
        keys = rows.select(self.key).distinct()
        if buckets is None:
            buckets = sorted(r[0] for r in keys.select(bucket_of([self.key], self.buckets).alias(BUCKET)).distinct().collect())
        there = numbered_folders(self.spark, self.path, BUCKET)
        paths = [there[b] for b in buckets if b in there]
        if not paths:
            return self.spark.createDataFrame([], T.StructType(self.schema.fields[:-1]))
        known = self.spark.read.option("basePath", self.path).schema(self.schema).parquet(*paths).drop(BUCKET)
        return known.join(keys, self.key, "left_semi")
