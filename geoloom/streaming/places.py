"""Collection as a stream (an extension: the batch rules over micro-batches).

New log files arrive in a folder; each place id is passed on once, within a
watermark that bounds the state.  ``first_success`` judges tries as the batch rule
does, in whatever order they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LOG = "seed_index int, place_id string, lat double, lng double, seen_at timestamp"


def log_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).json(folder)


def first_seen(log: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Each place id once; state older than the lateness is dropped."""
    return log.withWatermark("seen_at", lateness).dropDuplicatesWithinWatermark(["place_id"])


def seed_counts(log: DataFrame, window: str = "1 hour", lateness: str = "1 day") -> DataFrame:
    """Places for each seed and window of event time."""
    w = F.window("seen_at", window)
    return log.withWatermark("seen_at", lateness).groupBy(w, "seed_index").agg(F.approx_count_distinct("place_id").alias("places"))


TRY = "seed_index int, ord int, place_id string, success boolean, seen_at timestamp"
OUTCOME = "seed_index int, ord int, place_id string, outcome string"
#: The state store that timers need.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_JUDGED = Row("seed_index", "ord", "place_id", "outcome")


class FirstSuccess(StatefulProcessor):
    """Of each id the least successful try, the failed tries before it, the time of its last try and a timer.

    A try after a successful one is a duplicate whatever comes later, and leaves at
    once.  Others wait, as a try that comes late can still be the first in the order
    of the seeds, until the id's timer ends it: ``horizon_ms`` after its last try, by
    event time.  Then errors and the one written leave, and the state goes.  Calls
    for state cost more than rows do, so that one value holds all but the failed
    tries, and a timer that ends before the last try's horizon is only set anew then.
    """

    def __init__(self, horizon_ms: int) -> None:
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failed = handle.getListState("failed", "seed_index int, ord int")
        self.known = handle.getValueState("known", "ms long, waits boolean, seed_index int, ord int")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N803
        known = self.known.get()
        last, waits, *at = known or (None, False, None, None)
        latest, good, bad = last or 0, [] if at[0] is None else [tuple(at)], []
        for seed, ord_, _, success, seen_at in rows:
            (good if success else bad).append((seed, ord_))
            latest = max(latest, int(seen_at.timestamp() * 1000))
        first = min(good, default=None)
        if first is not None:
            good.remove(first)
        early = [t for t in bad if first is None or t <= first]
        if early:
            self.failed.appendList(early)
        now = (latest, waits or bool(early), *(first or (None, None)))
        if known is None:
            self.handle.registerTimer(latest + self.horizon_ms)
        if known is None or now != tuple(known):
            self.known.update(now)
        for t in good:
            yield _JUDGED(*t, key[0], "duplicate")
        if len(early) < len(bad):
            for t in bad:
                if t > first:
                    yield _JUDGED(*t, key[0], "duplicate")

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        last, waits, *at = self.known.get()
        if last + self.horizon_ms > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(last + self.horizon_ms)
            return
        first = None if at[0] is None else tuple(at)
        bad = [tuple(r) for r in self.failed.get()] if waits else []
        if waits:
            self.failed.clear()
        self.known.clear()
        for t in bad:
            yield _JUDGED(*t, key[0], "duplicate" if first and t > first else "error")
        if first:
            yield _JUDGED(*first, key[0], "written")

    def close(self) -> None:
        pass


def first_success(tries: DataFrame, lateness: str = "1 day", horizon_ms: int = 86_400_000) -> DataFrame:
    """(seed_index, ord, place_id, outcome) of a stream of tries (``TRY``); a new state begins for an id that is tried again after its horizon."""
    late = tries.select("seed_index", "ord", "place_id", "success", "seen_at").withWatermark("seen_at", lateness)
    return late.groupBy("place_id").transformWithState(FirstSuccess(horizon_ms), OUTCOME, "Append", "EventTime")
