"""Tracks from a stream of position files: each micro-batch is cleaned as one file, and vessels go on where the batch before left them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fairlead.config import Config
from fairlead.plans.pipeline import clean
from fairlead.plans.runs import load_state, save_state
from fairlead.sources import store
from fairlead.sources.scratch import keep


class BatchCleaner:
    """For ``foreachBatch``. State and registry are versioned by batch: a batch that is run again starts from the same version and replaces its own output, so results are exactly once. A batch whose predecessor's state is missing is an error, not a new start."""

    def __init__(self, out: str, state: str, config: Config, order: list[str]) -> None:
        self.out, self.state, self.config, self.order = out, state, config, order

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        past = known = None
        if epoch > 0:
            if not all(store.exists(spark, f"{self.state}/{name}-{epoch - 1}") for name in ("state", "registry")):
                raise RuntimeError(f"batch {epoch}: no state of batch {epoch - 1} under {self.state}")
            past, known = load_state(spark, self.state, str(epoch - 1))
        work = f"{self.state}/work-{epoch}"
        store.remove(spark, work)
        step = lambda df, name: keep(df, name, f"{work}/{name}")
        done = clean(batch.withColumn("file_seq", F.lit(0).cast("long")), self.config, order=self.order, state=past, registry=known, keep=step)
        done.tracks.drop("file_seq").write.mode("overwrite").parquet(f"{self.out}/batch={epoch}")
        save_state(done.state(past), done.registry, self.state, str(epoch))
        store.remove(spark, work)
        store.write_json(spark, {"batch": epoch}, f"{self.state}/last.json")


def stream_tracks(spark: SparkSession, source: str, schema, out: str, state: str, config: Config, *, order: list[str], checkpoint: str) -> StreamingQuery:
    """Starts a query over Parquet files in ``source``, one file a batch in order of their modification time."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    cleaner = BatchCleaner(out, state, config, order)
    return files.writeStream.foreachBatch(cleaner).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
