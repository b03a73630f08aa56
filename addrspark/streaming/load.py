"""Loading documents from a folder that lines keep arriving in.

Every line ends up in the table once: in the outcome ``good`` or ``bad``, however often it was delivered and
however often a batch was run. Ids that were loaded are state of the stream. Each batch overwrites the folder
of its own number, so one that is repeated after a failure replaces what its first run left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from addrspark.operators.dedup import last_wins
from addrspark.sources.readers import marked_ndjson

FILES_PER_BATCH = 1000
GOOD, BAD = "good", "bad"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BatchWriter = Callable[[DataFrame, int], None]


def arriving_lines(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A stream of the lines of all files in ``folder``, column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def judged_lines(lines: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """(value, row, outcome, reason, id): ``id`` names a good row by its key and a bad line by its digest.

    A good row whose key is null is named by its line, too.
    """
    marked = marked_ndjson(lines, "value", schema)
    named = F.coalesce(F.concat(F.lit("key "), F.col("row").getField(key).cast("string")), F.concat(F.lit("line "), F.sha2("value", 256)))
    good = F.col("reason").isNull()
    fields = F.struct(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields])
    return marked.select(
        "value",
        F.when(good, fields).alias("row"),
        F.when(good, F.lit(GOOD)).otherwise(F.lit(BAD)).alias("outcome"),
        "reason",
        F.when(good, named).otherwise(F.concat(F.lit("line "), F.sha2("value", 256))).alias("id"),
    )


def first_of_each(judged: DataFrame, event_time: str | None = None, forget_after: str | None = None) -> DataFrame:
    """Rows whose id has not been seen before; of a repeated id the row that arrives first stays.

    Ids stay in the state for good, so a repeat is found however late it comes. With ``event_time``, a field
    of the rows, and ``forget_after`` the state forgets an id that long after its time; then good rows that
    are later than that are left out by the watermark. Bad lines have no time and are dealt with as before.
    """
    if not (event_time and forget_after):
        return judged.dropDuplicates(["id"])
    good = judged.filter(F.col("outcome") == GOOD).withColumn("event_time", F.col("row").getField(event_time))
    timed = good.withWatermark("event_time", forget_after).dropDuplicatesWithinWatermark(["id"])
    return timed.drop("event_time").unionByName(judged.filter(F.col("outcome") == BAD).dropDuplicates(["id"]))


def batch_writer(out: str) -> BatchWriter:
    """Writes a batch under its number, by outcome; run again for one number, it replaces what is there."""

    def write(batch: DataFrame, number: int) -> None:
        numbered = batch.drop("id").withColumn("batch", F.lit(number).cast("bigint"))
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch", "outcome").parquet(out)

    return write


def start_load(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    key: str,
    out: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    event_time: str | None = None,
    forget_after: str | None = None,
    once: bool = True,
    write: BatchWriter | None = None,
) -> StreamingQuery:
    """Start loading ``source`` into ``out``; ``once`` takes what is there, batch by batch, and ends.

    ``checkpoint`` holds which files were read and the ids seen. A load that was stopped goes on from there
    when started again with the same folders.
    """
    own = spark.newSession()
    # Ids seen may outgrow the executors' memory.
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    empty = spark.createDataFrame([], written_schema(schema))
    empty.write.mode("append").partitionBy("batch", "outcome").parquet(out)
    judged = judged_lines(arriving_lines(own, source, files_per_batch), schema, key)
    kept = first_of_each(judged, event_time, forget_after)
    sink = kept.writeStream.foreachBatch(write or batch_writer(out)).option("checkpointLocation", checkpoint)
    return (sink.trigger(availableNow=True) if once else sink).start()


def load_available(spark: SparkSession, source: str, schema: T.StructType, key: str, out: str, checkpoint: str, **options) -> None:
    """Load all that has arrived in ``source`` and wait until it is done."""
    start_load(spark, source, schema, key, out, checkpoint, **options).awaitTermination()


def written_schema(schema: T.StructType) -> T.StructType:
    """What the table of a load holds."""
    return T.StructType(
        [
            T.StructField("value", T.StringType()),
            T.StructField("row", schema),
            T.StructField("reason", T.StringType()),
            T.StructField("batch", T.LongType()),
            T.StructField("outcome", T.StringType()),
        ]
    )


def loaded(spark: SparkSession, out: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines with the reason) of a table that was loaded; both empty before the first batch."""
    table = spark.read.schema(written_schema(schema)).parquet(out)
    return (
        table.filter(F.col("outcome") == GOOD).select("row.*"),
        table.filter(F.col("outcome") == BAD).select(F.col("value").alias("line"), "reason"),
    )


def start_counts(
    rows: DataFrame, event_time: str, width: str, by: list[str], out: str, checkpoint: str, lateness: str, once: bool = True
) -> StreamingQuery:
    """Count a stream's rows per window of ``event_time`` and ``by``, with updates for rows up to ``lateness`` late.

    Every batch writes the counts that it changed under its own number; ``current_counts`` reads the newest.
    The watermark bounds the state: a window is forgotten, and later rows for it left out, once it is past
    by ``lateness``.
    """
    timed = rows.withWatermark(event_time, lateness)
    counted = timed.groupBy(F.window(event_time, width).alias("span"), *by).agg(F.count(F.lit(1)).alias("n"))
    flat = counted.select(F.col("span.start").alias("begin"), F.col("span.end").alias("end"), *by, "n")

    def write(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("batch", F.lit(number).cast("bigint"))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    sink = flat.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (sink.trigger(availableNow=True) if once else sink).start()


def current_counts(spark: SparkSession, out: str, by: list[str]) -> DataFrame:
    """The newest count of every window: begin, end, ``by``, n."""
    return last_wins(spark.read.parquet(out), ["begin", "end", *by], "batch").select("begin", "end", *by, "n")


def event_rows(judged: DataFrame, *more: Column) -> DataFrame:
    """The good rows of a judged stream as columns, for ``start_counts``."""
    return judged.filter(F.col("outcome") == GOOD).select("row.*", *more)
