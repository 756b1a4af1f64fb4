"""Results kept up by increments: what each batch of posts adds to a result is written once, and merged when the result is read.

The parts are those of `PARTS`: sums, counts and maxima per tag, which merge in any order. A new file costs what it holds; reading
costs a row per tag and batch, and `merge_old` makes one part of many.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagpulse.operators import aggregates as agg
from tagpulse.operators import views
from tagpulse.sources.sinks import triggered
from tagpulse.streaming.folders import drop_before, files_of, numbered_folders, write_batch


def _counts(posts: DataFrame, **_) -> DataFrame:
    return agg.tag_counts(views.tag_rows(views.english_with_text(posts)))


def _words(posts: DataFrame, tags=None, **_) -> DataFrame:
    return agg.mean_words(agg.post_words(posts, tags)).drop("avg_words")


def _longest(posts: DataFrame, tags=None, **_) -> DataFrame:
    return agg.longest_word_places(agg.longest_word_rows(posts, tags))


def _tokens(posts: DataFrame, **_) -> DataFrame:
    return agg.token_stats(agg.token_rows(posts))


#: Of each result: what a batch adds, how columns merge, and how the merged ones are shown.
PARTS = {
    "tag_counts": (_counts, {"uses": F.sum}, ["tag", "uses"]),
    "mean_words": (_words, {"words": F.sum, "posts": F.sum, "last_ts": F.max},
                   ["tag", "words / posts AS avg_words", "posts", "words", "last_ts"]),
    "longest_words": (_longest, {"best": F.max}, ["tag", "best.word", "best.length"]),
    "token_stats": (_tokens, {"tokens": F.sum, "longest": F.max}, ["tag", "tokens", "longest"]),
}


def start_increments(posts: DataFrame, out, checkpoint, names=tuple(PARTS), tags=None, trigger=None) -> StreamingQuery:
    """Adds what streaming posts bring to the results `names` (of `PARTS`) under `out`; a repeated batch replaces what it wrote.
    `tags`, which the word results look for, stay the same for the life of `out`."""

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist() if len(names) > 1 else batch
        try:
            for name in names:
                write_batch(PARTS[name][0](rows, tags=tags), f"{out}/{name}", batch_id)
        finally:
            rows.unpersist()

    writer = posts.writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def _merged(parts: DataFrame, name) -> DataFrame:
    merges = PARTS[name][1]
    return parts.groupBy("tag").agg(*[merge(c).cast(parts.schema[c].dataType).alias(c) for c, merge in merges.items()])


def _base(spark: SparkSession, out, name) -> tuple[int, str | None]:
    """The last batch of the newest finished base, and its folder; -1 where there is none."""
    finished = {}
    for number, folder in numbered_folders(spark, f"{out}/{name}-base", "upto").items():
        files, mark = files_of(spark, f"{folder}/_SUCCESS")
        if files.exists(mark):
            finished[number] = folder
    return max(finished.items(), default=(-1, None))


def _parts(spark: SparkSession, out, name, until: int | None = None) -> DataFrame:
    """The newest base and the batches after it (up to `until`), each row once per part."""
    last, base = _base(spark, out, name)
    batches = [folder for n, folder in sorted(numbered_folders(spark, f"{out}/{name}").items()) if n > last and (until is None or n <= until)]
    return spark.read.parquet(*([base] if base else []), *batches)


def read_result(spark: SparkSession, out, name) -> DataFrame:
    """The result over all posts so far: as its program gives it over the same posts."""
    return _merged(_parts(spark, out, name), name).selectExpr(*PARTS[name][2])


def merge_old(spark: SparkSession, out, names=tuple(PARTS), keep: int = 2) -> None:
    """Makes one part, a base, of all but the newest `keep` batches of each result, which may still be repeated.

    A base counts once it is finished; broken off, it is written again. What a base replaces goes when the next one has been made, so
    that a reader that has listed it can still read it.
    """
    for name in names:
        batches = sorted(numbered_folders(spark, f"{out}/{name}"))
        until = batches[-1 - keep] if len(batches) > keep else -1
        last, _ = _base(spark, out, name)
        if until <= last:
            continue
        _merged(_parts(spark, out, name, until), name).write.mode("overwrite").parquet(f"{out}/{name}-base/upto={until}")
        drop_before(spark, f"{out}/{name}", last + 1)
        drop_before(spark, f"{out}/{name}-base", last, "upto")
