"""End to end: change feed -> landing tables -> mart refresh, after micro-batches, overdue and at the end."""

from __future__ import annotations

import datetime as _dt
import threading
import time
from collections.abc import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemart.plans import refresh as R
from tidemart.plans.landing import Landing
from tidemart.plans.refresh import RefreshFailed  # noqa: F401 - raised by the refreshes
from tidemart.session import scratch_path
from tidemart.streaming.apply import batch_writer, read_landed


class PipelineQuery(StreamingQuery):
    """The streaming query with its refreshes: it has ended when the last refresh has.

    ``awaitTermination`` and ``stop`` wait for that refresh and raise if it failed.
    """

    def __init__(self, query: StreamingQuery, watch: threading.Thread, failed: list[BaseException]) -> None:
        super().__init__(query._jsq)
        self._watch, self._failed = watch, failed

    @property
    def isActive(self) -> bool:
        return super().isActive or self._watch.is_alive()

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        t0 = time.monotonic()
        if timeout is None:
            super().awaitTermination()
            self._watch.join()
        else:
            if not super().awaitTermination(timeout):
                return False
            self._watch.join(max(0.0, timeout - (time.monotonic() - t0)))
            if self._watch.is_alive():
                return False
        self._raise()
        return None if timeout is None else True

    def stop(self) -> None:
        super().stop()
        self._watch.join()
        self._raise()

    def _raise(self) -> None:
        if self._failed:
            raise self._failed[0]


def start_pipeline(feed: DataFrame, landing_root: str, mart_root: str, tables: Iterable[str],
                   as_of: Callable[[], _dt.date], group: str = "all",
                   as_of_events: Callable[[], _dt.date] | None = None,
                   checkpoint: str | None = None, processing_time: str | None = None,
                   refresh_every: float = 600.0, name: str = "pipeline") -> StreamingQuery:
    """Each micro-batch is landed; the mart group is refreshed over the landed
    tables at most every ``refresh_every`` seconds (0: after every batch), so ingest
    does not wait for marts. A timer refreshes what no later batch does, and a last
    refresh runs when the query ends or is stopped with batches not yet in the marts; a
    start counts as such, for an earlier run may have ended in between.
    Landing and window replacement are idempotent: a replayed
    batch converges to the same marts. A failed mart raises: in a batch, so that it is
    retried rather than leaving it stale; in the timer or at the end, from the query's
    ``awaitTermination`` or ``stop``. ``as_of`` is called per refresh (e.g.
    today's UTC date in production)."""
    spark = feed.sparkSession
    if checkpoint is None:
        checkpoint = scratch_path(spark, "streams", name)
    tables = list(tables)
    land = batch_writer(landing_root, tables, name, checkpoint)
    turn = threading.Lock()  # a refresh does not read tables that a batch is writing
    last, stale, failed = [float("-inf")], [True], []

    def refresh(session) -> None:
        L = Landing(lambda t: read_landed(session, landing_root, t))
        # a micro-batch whose own refresh failed is not committed and is retried
        R.all_refreshed(R.run(session, L, mart_root, as_of(), group=group,
                              as_of_events=as_of_events() if as_of_events else None))
        last[0], stale[0] = time.monotonic(), False

    def process(batch: DataFrame, batch_id: int) -> None:
        with turn:
            stale[0] = True
            land(batch, batch_id)
            if time.monotonic() - last[0] >= refresh_every:
                refresh(batch.sparkSession)

    def watch(query: StreamingQuery) -> None:
        began = time.monotonic()
        try:
            while not query.awaitTermination(1):
                with turn:
                    if stale[0] and time.monotonic() - max(began, last[0]) >= max(refresh_every, 1.0) and query.isActive:
                        refresh(spark)
        except StreamingQueryException:
            return  # raised to the caller by the query; its batch is retried
        except BaseException as e:  # noqa: BLE001 - raised to the caller
            failed.append(e)
            query.stop()
            return
        try:
            with turn:
                if stale[0]:
                    refresh(spark)
        except BaseException as e:  # noqa: BLE001
            failed.append(e)

    w = feed.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    query = w.start()
    thread = threading.Thread(target=watch, args=(query,), name=f"{name}-refresh")
    thread.start()
    return PipelineQuery(query, thread, failed)
