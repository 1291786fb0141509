"""Incremental ingest: new files of a landing folder through S00 and S01, a micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import ingest
from quarry.plans.stages import normalise


def source_rows(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).load(folder)


def ingest_stream(rows: DataFrame, remember: str = "1 day") -> DataFrame:
    """Documents of a stream of source rows, each doc_id once within `remember` of its arrival; the state holds the ids of that time."""
    docs = ingest.documents(rows if "source_row" in rows.columns else rows.withColumn("source_row", F.lit(0)))
    return docs.withColumn("_at", F.current_timestamp()).withWatermark("_at", remember).dropDuplicatesWithinWatermark(["doc_id"]).drop("_at")


def run_incremental(spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str, fmt: str = "parquet", remember: str = "1 day") -> StreamingQuery:
    """Appends documents, normalised documents and blocks of all files not seen before, each doc_id once (see ingest_stream); a batch that is repeated after a failure writes over itself."""

    def write(docs: DataFrame, number: int) -> None:
        docs.write.mode("overwrite").parquet(f"{out}/documents/batch={number}")
        normalized, blocks = normalise(spark.read.parquet(f"{out}/documents/batch={number}"))
        for name, table in (("documents_normalized", normalized), ("blocks", blocks)):
            table.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    docs = ingest_stream(source_rows(spark, landing, schema, fmt), remember)
    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
