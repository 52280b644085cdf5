"""The life of cached uploads as timed state: fresh, then to be validated, then gone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..plans.model import CHECK_AFTER, GONE_AFTER

_HOUR = 3_600_000
CHANGES = "key string, state string, uploaded_at timestamp, since timestamp"


class CacheLife(StatefulProcessor):
    """For each key the time of its last upload, and a timer for its next change.

    An upload makes a key fresh, unless a later one is known; what is old already when it arrives is at once what its age says.  A
    timer then makes it one to validate, a second one expired, and its state goes.
    """

    def __init__(self, check_after: float = CHECK_AFTER, gone_after: float = GONE_AFTER):
        self.check, self.gone = int(check_after * _HOUR), int(gone_after * _HOUR)

    def init(self, handle) -> None:  # noqa: ANN001
        self.handle = handle
        self.uploaded = handle.getValueState("uploaded", T.StructType([T.StructField("ms", T.LongType())]))

    def _change(self, key: tuple, state: str, uploaded: int, since: int) -> pd.DataFrame:
        stamp = lambda ms: pd.to_datetime([ms], unit="ms")
        return pd.DataFrame({"key": [key[0]], "state": [state], "uploaded_at": stamp(uploaded), "since": stamp(since)})

    def _advance(self, key: tuple, uploaded: int, now: int) -> Iterator[pd.DataFrame]:
        """The state that the age gives, and the timer for the next one."""
        age = now - uploaded
        if age >= self.gone:
            self.uploaded.clear()
            yield self._change(key, "expired", uploaded, uploaded + self.gone)
        elif age >= self.check:
            self.handle.registerTimer(uploaded + self.gone)
            yield self._change(key, "validate", uploaded, uploaded + self.check)
        else:
            self.handle.registerTimer(uploaded + self.check)
            yield self._change(key, "fresh", uploaded, uploaded)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        newest = max(int(v) for part in rows for v in part["uploaded_ms"])
        if self.uploaded.exists():
            known = self.uploaded.get()[0]
            if newest <= known:
                return
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.uploaded.update((newest,))
        yield from self._advance(key, newest, max(0, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        if not self.uploaded.exists():
            return
        uploaded, due = self.uploaded.get()[0], expiredTimerInfo.getExpiryTimeInMs()
        now = max(due, timerValues.getCurrentWatermarkInMs())
        if due < uploaded + self.gone <= now:  # both changes lie between two batches
            yield self._change(key, "validate", uploaded, due)
        yield from self._advance(key, uploaded, now)

    def close(self) -> None:
        pass


def cache_changes(uploads: DataFrame, key: str = "hash", uploaded_at: str = "uploaded_at", seen_at: str = "seen_at", delay: str = "0 seconds", check_after: float = CHECK_AFTER, gone_after: float = GONE_AFTER) -> DataFrame:
    """(key, state, uploaded_at, since): a row for each change of a key's state, from a stream of uploads.

    ``seen_at`` is the time of the log, whose watermark (less ``delay``) is "now"; an upload may be older than that.  State is one number and
    one timer a key, kept in RocksDB and recovered from the checkpoint.  The last change of each key is what ``model.cache_state`` says
    for it at the watermark.  Uploads without a time, or without a key, take no part.
    """
    spark = uploads.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = uploads.where(F.col(key).isNotNull() & F.col(uploaded_at).isNotNull()).withWatermark(seen_at, delay)
    rows = rows.select(F.col(key).cast("string").alias("key"), F.col(seen_at), F.unix_millis(uploaded_at).alias("uploaded_ms"))
    return rows.groupBy("key").transformWithStateInPandas(CacheLife(check_after, gone_after), CHANGES, "Append", "EventTime")
