"""Keyed upsert with Spark's state store: per key only the newest version is remembered.

The landing stream's way 2 rewrites its state with every batch. Here each key's newest
record lives in the state store (RocksDB, checkpointed by Spark),
and a batch emits a row only for keys it really moves forward: late, repeated and
overtaken records end here. What is written follows the batch, not the table. The emitted
rows go into a ``LandingStore`` as one batch of its tail, under the name of the stream and batch id, so a
replayed batch changes nothing.

The newest record is a streaming aggregate, ``max_by`` over (version, arrival), so all of it runs in the
JVM; a call to Python per key took longer than anything else. The record carries the time of the
batch that brought it, which Spark keeps in the offset log (a replay sees the same one): a key has moved forward in
a batch exactly if its newest record is of that batch. Among equal records the earliest wins.

Tombstones stay in the state, so that a late older version still loses to them, however late;
the state has one record per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.plans.store import LandingStore
from tidemart.sources.schemas import IS_DELETED, LANDING, SYNCED_AT, VERSION
from tidemart.streaming.apply import CORRUPT, ENVELOPE, parse_envelope, parsed_records, stream_id

KEY, SEEN, NEWEST = "row_key", "seen_us", "newest"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newer_records(feed: DataFrame, table: str, key_mode: str = "sort_key") -> DataFrame:
    """Streaming change records of ``table`` that move their key forward."""
    t = LANDING[table]
    good = parsed_records(feed, table).where(F.col(CORRUPT).isNull())
    key = F.to_json(F.struct(*[F.col("r")[c].alias(c) for c in t.key(key_mode)]))
    now = F.unix_micros(F.current_timestamp())  # the same in the whole batch
    records = good.select(key.alias(KEY), *ENVELOPE.names, now.alias(SEEN))
    newest = F.max_by(F.struct(*ENVELOPE.names, SEEN), F.struct(F.col(VERSION), F.col(SYNCED_AT), -F.col(SEEN)))
    return (records.groupBy(KEY).agg(newest.alias(NEWEST)).where(F.col(NEWEST)[SEEN] == now)
            .select(*[F.col(NEWEST)[c].alias(c) for c in ENVELOPE.names]))


def upsert_stream(feed: DataFrame, store: LandingStore, table: str, checkpoint: str, name: str = "upsert",
                  processing_time: str | None = None, key_mode: str = "sort_key") -> StreamingQuery:
    """Start the upsert; without ``processing_time`` it takes what is there (availableNow) and stops."""
    spark = feed.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        store.append(table, parse_envelope(batch, table), f"{name}-{stream_id(spark, checkpoint)}-{batch_id:09d}")

    held = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # read when the query starts
    try:
        w = (newer_records(feed, table, key_mode).writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint))
        return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()
    finally:
        if held is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, held)
