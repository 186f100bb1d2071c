"""Incremental loads: a stream of files upserted into a store, batch by batch.

Ids are deterministic and a batch is named in the log of the table that takes it, so one that runs again after a failure
leaves the store as it was. Other tables of the store are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from brightledger.sources.store import Store


def upsert_batch(store: Store, name: str, batch: DataFrame, key: str, seq: str, token: tuple[str, int] | None = None) -> int:
    """The next version of a store, with a batch upserted into a table: the later ``seq`` wins, whichever side it is on."""
    return store.upsert(name, batch, [key], seq, token=token)


def upsert_stream(spark: SparkSession, source: str, schema: str, store_path: str, name: str, checkpoint: str, key: str = "id", seq: str = "seq") -> StreamingQuery:
    """Starts a query that upserts new Parquet files of ``source``; it ends when all present files are in.

    A micro-batch writes its own rows. Its number goes into the table's log, so one that runs again is not taken twice.
    """
    store = Store(spark, store_path)
    stream = spark.readStream.schema(schema).parquet(source)
    writer = stream.writeStream.foreachBatch(lambda batch, n: upsert_batch(store, name, batch, key, seq, (checkpoint, n)))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
