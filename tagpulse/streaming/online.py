"""Regression refined by every closed window of a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from tagpulse.operators.regression import SUMS, online_predictions, point_sums
from tagpulse.sources.sinks import triggered
from tagpulse.streaming.folders import drop_before, read_batch, write_batch


def start_online_regression(cells: DataFrame, x, y, out, checkpoint, xy=None, trigger=None) -> StreamingQuery:
    """Writes each closed window's cells with the prediction at them to `out/predictions`.

    Windows close in order, so the cells of a batch come after those of all earlier batches. The
    model is five sums; a batch starts from those that the previous one wrote, and all it writes
    is keyed by its number, so repeating a batch changes nothing.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        closed = write_batch(batch, f"{out}/cells", batch_id)
        sums = point_sums(closed, x, y, xy)
        before = read_batch(spark, f"{out}/sums", batch_id - 1, sums.schema)
        if before is not None:
            sums = sums.unionByName(before).agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in SUMS])
        seed = before.first().asDict() if before is not None else None  # one row of five numbers
        write_batch(online_predictions(closed, x, y, xy, before=seed), f"{out}/predictions", batch_id)
        write_batch(sums, f"{out}/sums", batch_id)
        drop_before(spark, f"{out}/sums", batch_id - 1)
        drop_before(spark, f"{out}/cells", batch_id)

    writer = cells.writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def read_predictions(spark: SparkSession, out) -> DataFrame:
    return spark.read.parquet(f"{out}/predictions").drop("batch_id")
