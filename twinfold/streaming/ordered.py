"""Calls in the order of their time, whatever order they arrive in: state, timers and what is kept of a resource's past.

Calls wait in slices of time. Once the watermark has passed the end of a slice, no call of it can arrive any more; then
its calls are sorted and released, one slice after the other. So a task holds one slice of one resource, however
many calls a micro-batch brings, and results don't depend on how calls were dealt to batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.calls import outage_fold
from ..shipping import ship

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State of streams that start inside is kept by RocksDB, which timers and several state variables need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class InOrder(StatefulProcessor):
    """Buffers the calls (us, call_id, ok) of a resource in slices and releases complete ones in order."""

    def __init__(self, slice_us: int):
        self.slice_us = slice_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slice long", "us array<long>, call_id array<long>, ok array<boolean>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            for at, calls in part.groupby(part["us"] // self.slice_us):
                at, new = (int(at),), [calls[c].tolist() for c in ("us", "call_id", "ok")]
                held = self.waiting.getValue(at) if self.waiting.containsKey(at) else None
                self.waiting.updateValue(at, tuple([*old, *more] for old, more in zip(held or ([], [], []), new, strict=True)))
                if not held:
                    self.handle.registerTimer(-(-(at[0] + 1) * self.slice_us // 1000))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        for at in sorted(k[0] for k in self.waiting.keys() if (k[0] + 1) * self.slice_us <= upto):
            calls = pd.DataFrame(dict(zip(("us", "call_id", "ok"), self.waiting.getValue((at,)), strict=True))).sort_values(["us", "call_id"])
            self.waiting.removeKey((at,))
            yield from self.release(key[0], at, calls)
        yield from self.pause(key[0], upto)

    def release(self, resource: str, at: int, calls: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The calls of a complete slice in order."""
        raise NotImplementedError

    def pause(self, resource: str, upto: int) -> Iterator[pd.DataFrame]:
        """No call before this time is waiting or to come."""
        return iter(())

    def close(self) -> None:
        pass


class Outages(InOrder):
    """The state of each resource after each call, and a row of its own for every outage whose rest is over, call or no call."""

    def __init__(self, after: int, rest_us: int, closes: int, slice_us: int):
        super().__init__(slice_us)
        self.after, self.rest_us, self.closes = after, rest_us, closes

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("state", "state string, bad int, good int, since long, told boolean")

    def _now(self) -> dict:
        kept = self.state.get() if self.state.exists() else ("closed", 0, 0, 0, False)
        return dict(zip(("state", "bad", "good", "since", "told"), kept, strict=True))

    def _keep(self, now: dict) -> None:
        if now["state"] == "closed" and not now["bad"]:
            self.state.clear()  # as a resource that was never seen
        else:
            self.state.update((now["state"], now["bad"], now["good"], now["since"], now["told"]))

    def release(self, resource: str, at: int, calls: pd.DataFrame) -> Iterator[pd.DataFrame]:
        now, out = self._now(), []
        for us, call_id, ok in zip(calls["us"].tolist(), calls["call_id"].tolist(), calls["ok"].tolist(), strict=True):
            if now["state"] == "open" and not now["told"] and us - now["since"] >= self.rest_us:
                out.append((resource, None, now["since"] + self.rest_us, "half_open", False))
            ((state, suppressed),) = outage_fold([us], [ok], now, self.after, self.rest_us, self.closes)
            now["told"] &= suppressed
            out.append((resource, call_id, us, state, suppressed))
        self._keep(now)
        yield _frame(out)

    def pause(self, resource: str, upto: int) -> Iterator[pd.DataFrame]:
        now = self._now()
        if now["state"] != "open" or now["told"]:
            return
        ends = now["since"] + self.rest_us
        if ends <= upto:
            # calls before this moment that still wait find the outage open, and don't change it
            self._keep(now | {"told": True})
            yield _frame([(resource, None, ends, "half_open", False)])
        else:
            self.handle.registerTimer(-(-ends // 1000))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["resource", "call_id", "us", "state", "suppressed"]).astype({"call_id": "Int64", "us": "int64", "suppressed": "bool"})


class Usage(InOrder):
    """Calls in two trailing closed windows of a resource at each call; times of calls leave the state with the long window."""

    def __init__(self, short_us: int, long_us: int, slice_us: int):
        super().__init__(slice_us)
        self.short_us, self.long_us = short_us, long_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.past = handle.getMapState("past", "slice long", "us array<long>")

    def release(self, resource: str, at: int, calls: pd.DataFrame) -> Iterator[pd.DataFrame]:
        own = calls["us"].to_numpy()
        kept = [k[0] for k in self.past.keys()]
        before = []
        for k in sorted(kept):
            if (k + 1) * self.slice_us <= own[0] - self.long_us:
                self.past.removeKey((k,))
            else:
                before.append(np.array(self.past.getValue((k,))[0], dtype=np.int64))
        self.past.updateValue((at,), (own.tolist(),))
        times = np.concatenate([*before, own])  # slices in order, so sorted
        # a call at the same moment counts for both
        end, short, long = (np.searchsorted(times, own, side="right"), np.searchsorted(times, own - self.short_us), np.searchsorted(times, own - self.long_us))
        yield pd.DataFrame({"resource": resource, "call_id": calls["call_id"].to_numpy(), "us": own, "n_short": end - short, "n_long": end - long, "oldest": times[short]})

    def pause(self, resource: str, upto: int) -> Iterator[pd.DataFrame]:
        # an idle resource forgets its last calls, too
        leaves = {k[0]: (k[0] + 1) * self.slice_us + self.long_us for k in self.past.keys()}
        for k, moment in leaves.items():
            if moment <= upto:
                self.past.removeKey((k,))
        later = [moment for moment in leaves.values() if moment > upto]
        if later:
            self.handle.registerTimer(-(-min(later) // 1000))
        return iter(())


def _released(stream: DataFrame, processor: InOrder, schema: str, late: str) -> DataFrame:
    ship(stream.sparkSession)
    rows = stream.withWatermark("ts", late).select("resource", "call_id", "ts", F.unix_micros("ts").alias("us"), "ok")
    return rows.groupBy("resource").transformWithStateInPandas(processor, schema, "append", "eventTime")


def stream_outage_state(stream: DataFrame, after: int = 5, rest_s: int = 30, closes: int = 2, late: str = "1 day", slice_s: int = 3600) -> DataFrame:
    """resource, call_id, ts, state, suppressed: as `outage_state` has it, for each call once its slice of time is complete.

    A call_id of null is a timed change: an outage whose rest is over turns half open at that moment without a call, by
    an event-time timer. A healthy resource keeps no state; the watermark is `late` behind the latest call, and calls
    behind it are dropped. Start the query inside rocksdb().
    """
    out = _released(stream, Outages(after, rest_s * 1_000_000, closes, slice_s * 1_000_000), "resource string, call_id long, us long, state string, suppressed boolean", late)
    return out.select("resource", "call_id", F.timestamp_micros("us").alias("ts"), "state", "suppressed")


def stream_quota_usage(stream: DataFrame, short_s: int, long_s: int, short_cap: int, long_cap: int, late: str = "1 day", slice_s: int = 3600) -> DataFrame:
    """The columns of `quota_usage`, for each call once its slice of time is complete: exact trailing counts, not windows on a grid.

    The times of a resource's calls are kept for the long window and evicted by timers. Start the query inside rocksdb().
    """
    out = _released(stream, Usage(short_s * 1_000_000, long_s * 1_000_000, slice_s * 1_000_000), "resource string, call_id long, us long, n_short long, n_long long, oldest long", late)
    share = F.greatest(F.col("n_short") / short_cap, F.col("n_long") / long_cap)
    wait = F.when(F.col("n_short") >= short_cap, (F.col("oldest") + short_s * 1_000_000 - F.col("us")) / 1e6).otherwise(0.0)
    return out.select("call_id", "resource", "n_short", "n_long", share.alias("share"), (share >= 0.8).alias("near_limit"), wait.alias("wait_s"))
