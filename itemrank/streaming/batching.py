"""ST2: micro-batches of a fixed size, or of what has come when the wait is over.

Events are dealt to ``lanes``; each lane is one key of a stateful operator
that keeps its waiting events in the state store.  A lane gives out a batch as
soon as it holds ``size`` events; the first event of a batch sets a
processing-time timer, and when that fires first, the batch goes out as it is.
Each event comes out once, with its lane, the number of its batch there and
what set the batch off.

A lane's state is below ``size`` events; its input is taken frame by frame, so
a task never holds more than a frame and a batch.  Batch sizes depend only on
the events of the lane and on the timers, not on how Spark cuts micro-batches.
State lives in the query's checkpoint (RocksDB provider), so a restart goes on
with the events that wait.
"""

from __future__ import annotations

import sys
import time

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from .. import schemas
from ..session import scratch_path

# The processor runs in executor Python workers: ship this module by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 100
WAIT_SECONDS = 5.0
LANES = 4
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_EVENT = "event_id long, user_id long, movie_id long, rating double, timestamp long"
_COLUMNS = [f.name for f in schemas.RATING_EVENTS.fields]
OUT = f"lane long, batch long, set_off_by string, {_EVENT}"


class SizeOrTime(StatefulProcessor):
    """Collects a key's events; gives them out ``size`` at a time or when ``wait_ms`` have passed."""

    def __init__(self, size: int, wait_ms: int):
        self.size, self.wait_ms = size, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _EVENT)
        self.next_batch = handle.getValueState("next_batch", "n long")
        self.due = handle.getValueState("due", "at long")

    def _number(self) -> int:
        return self.next_batch.get()[0] if self.next_batch.exists() else 0

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []

    def _no_timer(self) -> None:
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
            self.due.clear()

    def _batch(self, lane, number: int, events: list[tuple], set_off_by: str) -> pd.DataFrame:
        out = pd.DataFrame(events, columns=_COLUMNS, dtype=object)
        out.insert(0, "set_off_by", set_off_by)
        out.insert(0, "batch", number)
        out.insert(0, "lane", lane)
        return out

    def handleInputRows(self, key, rows, timerValues):
        held, number = self._held(), self._number()
        started = False
        for frame in rows:
            frame = frame[_COLUMNS].astype(object).where(frame[_COLUMNS].notna(), None)
            for event in frame.itertuples(index=False, name=None):
                held.append(event)
                if len(held) == self.size:
                    yield self._batch(key[0], number, held, "size")
                    held, number, started = [], number + 1, True
        self.next_batch.update((number,))
        if started:
            self._no_timer()
        if not held:
            self.waiting.clear()
            return
        self.waiting.put(held)
        if not self.due.exists():
            at = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(at)
            self.due.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held, number = self._held(), self._number()
        self.due.clear()
        self.waiting.clear()
        if held:
            self.next_batch.update((number + 1,))
            yield self._batch(key[0], number, held, "time")

    def close(self) -> None:
        pass


def size_or_time_batches(events: DataFrame, size: int = SIZE, wait_seconds: float = WAIT_SECONDS,
                         lanes: int = LANES) -> DataFrame:
    """(lane, batch, set_off_by, event columns) of a stream of rating events, batch by batch.

    The lane is ``event_id`` modulo ``lanes`` (0 for a null id).  Needs the
    RocksDB state store; ``start`` sets it.
    """
    laned = events.select(F.coalesce(F.pmod("event_id", F.lit(lanes)), F.lit(0)).cast("long").alias("lane"), *_COLUMNS)
    return laned.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=SizeOrTime(size, round(1000 * wait_seconds)), outputStructType=OUT, outputMode="Append",
        timeMode="ProcessingTime")


def start(spark: SparkSession, events: DataFrame, sink: str | None = None, size: int = SIZE,
          wait_seconds: float = WAIT_SECONDS, lanes: int = LANES, poll: str = "2 seconds") -> tuple[StreamingQuery, str]:
    """Start writing batches to ``sink``/batches (idempotent by micro-batch); returns the query and the table's path."""
    sink = sink or scratch_path(spark, "size-or-time")

    def handle(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink}/batches/batch_id={batch_id}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        query = (size_or_time_batches(events, size, wait_seconds, lanes).writeStream.outputMode("append").foreachBatch(handle)
                 .option("checkpointLocation", f"{sink}/_checkpoint").trigger(processingTime=poll).start())
    finally:
        spark.conf.set(PROVIDER, before)
    return query, f"{sink}/batches"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{OUT}, batch_id long").parquet(path).drop("batch_id")


def wait_for(spark: SparkSession, query: StreamingQuery, path: str, n_events: int, timeout: float = 300.0) -> None:
    """Return when ``n_events`` have come out; a failed or too slow query is an error."""
    end = time.monotonic() + timeout
    while time.monotonic() < end:
        if query.exception() is not None:
            raise query.exception()
        done = [p for p in query.recentProgress if p.batchId >= 0]
        if done and read_batches(spark, path).count() >= n_events:
            return
        time.sleep(0.5)
    raise TimeoutError(f"{n_events} events did not come out in {timeout} s")


def stop(query: StreamingQuery, timeout: float = 10.0) -> None:
    """Stop between two triggers: the query looks at its timers all the time, also without events."""
    end = time.monotonic() + timeout
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.01)
    query.stop()
