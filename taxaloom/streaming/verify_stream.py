"""Verification of a stream of names."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from taxaloom.operators.prepare import is_blank
from taxaloom.plans.verify import build_index, verify
from taxaloom.session import cut, scope

#: Next to the rows of the batches; readers of these skip it for its underscore.
METRICS = "_metrics"


def verify_stream(
    names: DataFrame,
    records: DataFrame,
    data_sources: DataFrame,
    path: str,
    checkpoint: str,
    relaxed: bool = False,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Verify each micro-batch and write its flat rows below ``path``.

    Ranking needs windows that streams do not have, so a batch runs the batch
    plan against an index of the records, which is built once, in buckets that
    batches join without shuffling it. A batch that is run again overwrites its
    own folder: with the checkpoint every name is written exactly once. Tables
    that a batch writes in between are removed after its output. ``trigger`` has
    the arguments of Spark's trigger; without, all that is there is taken.
    """
    index = build_index(records, data_sources, relaxed, by_source=bool(options.get("sources")))

    def verified(batch: DataFrame, batch_id: int) -> None:
        spark, start = batch.sparkSession, time.monotonic()
        with scope(spark):
            seen = Observation("names")
            # A batch may come as one file, which is one task's.
            rows = cut(batch.select("row_id", "name").observe(
                seen, F.count(F.lit(1)).alias("names"), F.count_if(is_blank(F.col("name"))).alias("errors")
            ).repartition(spark.sparkContext.defaultParallelism))
            flat = verify(rows, index, data_sources, **options).flat()
            flat.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        seconds = max(time.monotonic() - start, 1e-3)
        row = (seen.get["names"], seen.get["errors"], seen.get["names"] / seconds)
        spark.createDataFrame([row], MEASURED).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/{METRICS}/batch_id={batch_id}"
        )

    return (
        names.writeStream.foreachBatch(verified)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


MEASURED = "names long, errors long, names_per_second double"


def stream_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Per micro-batch of a stream below ``path`` the names verified, those of them
    that are blank, as observed while the batch was read, and the rate."""
    found = spark.read.schema(f"{MEASURED}, batch_id long").parquet(f"{path}/{METRICS}")
    return found.select("batch_id", "names", "errors", "names_per_second")
