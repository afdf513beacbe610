"""Stateful stream operators: pending/firing, cooldown, heartbeat timers.

Each keeps one small value per key in the state store, so executors can be lost and
the query resumes from its checkpoint. They need the RocksDB state store provider.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """Select the state store the operators of this module need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class HeldCondition(StatefulProcessor):
    """Condition samples (key, at, active) → (key, at, since, state), at full precision.

    Of samples with equal times an inactive one comes last, so that it resets. A late sample counts too: an inactive one inside the
    current run ends it, an active one gets its state from the run it falls into.
    """

    def __init__(self, hold_seconds: int, step_seconds: int):
        self.hold = hold_seconds * 1_000_000
        self.step = step_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "since bigint, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        points = pd.concat(list(rows)).sort_values(["at", "active"], ascending=[True, False])
        since, last = self.run.get() if self.run.exists() else (None, None)
        out = []
        for at, active in zip(points["at"], points["active"]):
            now = at.value // 1000
            late = last is not None and now < last
            if not active:
                if not late or (since is not None and now >= since):
                    since = None
            else:
                if late:
                    start = since if since is not None and since <= now else now
                else:
                    start = since = now if since is None or now - last > self.step else since
                state = "firing" if now - start >= self.hold else "pending"
                out.append((key[0], at, pd.Timestamp(start, unit="us"), state))
            last = now if last is None else max(last, now)
        if last is not None:
            self.run.update((since, last))
        if out:
            yield pd.DataFrame(out, columns=["alert", "at", "since", "state"])

    def close(self) -> None:
        pass


#: First and last time of stored samples, and a number that tells chunks of equal times apart.
Chunk = tuple[int, int, int]


def merged(parts: list[np.ndarray]) -> np.ndarray:
    """Columns (time, active samples, inactive samples) of all parts, ascending, one column a time."""
    counts = np.concatenate(parts, axis=1)
    counts = counts[:, np.argsort(counts[0], kind="stable")]
    first = np.flatnonzero(np.r_[True, counts[0, 1:] != counts[0, :-1]])
    return np.vstack([counts[0, first], np.add.reduceat(counts[1:], first, axis=1)])


def overlapping(chunks: list[Chunk]) -> int:
    """How many of the chunks (ordered by time) cover one time, at most."""
    ends, most = [], 0
    for first, last, _ in chunks:
        while ends and ends[0] < first:
            heapq.heappop(ends)
        heapq.heappush(ends, last)
        most = max(most, len(ends))
    return most


class HeldRuns(StatefulProcessor):
    """Condition samples (key, at, active) → (key, at, since, state, samples), corrected by late samples.

    Samples newer than the watermark stay in the state, by time; those it has passed are folded
    into one boundary (start of the run they end in, last time). A late sample that splits,
    joins or extends a run so changes the states behind it, and these are sent again: the last
    version of each time is the same for any cut into micro-batches. Of samples with equal times
    the inactive ones come last, so that they reset.

    A key may have any number of samples: they are sorted externally. ``SORTED`` of them at once
    are sorted and stored as chunks of ``CHUNK`` times; sweeps over the state merge the chunks
    that overlap and hold no others.
    """

    #: Samples that are sorted at once, times in a chunk, and chunks that may overlap before a sweep stores them merged.
    SORTED, CHUNK, DEPTH = 1 << 19, 1 << 14, 16

    def __init__(self, hold_seconds: int, step_seconds: int):
        self.hold = hold_seconds * 1_000_000
        self.step = step_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.boundary = handle.getValueState("boundary", "since bigint, last bigint")
        self.chunks = handle.getMapState("chunks", "first bigint, last bigint, number bigint", "counts binary")

    def stored(self) -> list[Chunk]:
        """Chunks of the key at hand, by time; the ones stored next get higher numbers."""
        chunks = sorted(self.chunks.keys())
        self.number = max((number for _, _, number in chunks), default=0)
        return chunks

    def put(self, counts: np.ndarray) -> None:
        for begin in range(0, counts.shape[1], self.CHUNK):
            part = counts[:, begin : begin + self.CHUNK]
            self.number += 1
            self.chunks.updateValue((int(part[0, 0]), int(part[0, -1]), self.number), (part.tobytes(),))

    def remove(self, chunks: list[Chunk]) -> None:
        for chunk in chunks:
            self.chunks.removeKey(chunk)

    def add(self, rows: Iterator[pd.DataFrame]) -> tuple[int, int]:
        """Store new samples; returns their first and last time."""
        held, size, ends = [], 0, []
        for points in rows:
            times = points["at"].astype("datetime64[us]").astype("int64")
            held.append(np.array([times, points["active"].eq(True), points["active"].eq(False)], np.int64))
            ends = [min([*ends, int(times.min())]), max([*ends, int(times.max())])]
            size += len(points)
            if size >= self.SORTED:
                self.put(merged(held))
                held, size = [], 0
        if held:
            self.put(merged(held))
        return ends[0], ends[1]

    def sweep(self, chunks: list[Chunk]) -> Iterator[np.ndarray]:
        """Counts of the given chunks (ordered by time) in ascending pieces; each time is in one piece."""
        at_once = max(4, overlapping(chunks))
        rest = np.empty((3, 0), np.int64)
        for i in range(0, len(chunks), at_once):
            loaded = chunks[i : i + at_once]
            rest = merged([rest, *(np.frombuffer(self.chunks.getValue(c)[0], np.int64).reshape(3, -1) for c in loaded)])
            following = chunks[i + at_once : i + at_once + 1]
            end = int(np.searchsorted(rest[0], following[0][0])) if following else rest.shape[1]
            piece, rest = rest[:, :end], rest[:, end:]
            if end:
                yield piece

    def follow(self, since: int | None, last: int | None, counts: np.ndarray) -> tuple[np.ndarray, int | None, int | None]:
        """Start of the run for the active samples of each time; start of the run and time for what comes after them."""
        times, active, goes_on = counts[0], counts[1] > 0, (counts[1] > 0) & (counts[2] == 0)
        joined = np.empty(len(times), bool)
        joined[0] = since is not None and times[0] <= last + self.step
        joined[1:] = goes_on[:-1] & (times[1:] <= times[:-1] + self.step)
        begin = np.maximum.accumulate(np.where(active & ~joined, np.arange(len(times)), -1))
        starts = np.where(begin < 0, times[0] if since is None else since, times[begin])
        return starts, int(starts[-1]) if goes_on[-1] else None, int(times[-1])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.stored()
        earliest, newest = self.add(rows)
        self.handle.registerTimer(newest // 1000 + 1)
        since, last = self.boundary.get() if self.boundary.exists() else (None, None)
        chunks = self.stored()
        merge = overlapping(chunks) > self.DEPTH
        for counts in self.sweep(chunks):
            if merge:
                self.put(counts)
            starts, since, last = self.follow(since, last, counts)
            sent = (counts[0] >= earliest) & (counts[1] > 0)
            if sent.any():
                at, start = counts[0, sent], starts[sent]
                yield pd.DataFrame({
                    "alert": pd.Series([key[0]] * len(at), dtype=object), "at": at.view("datetime64[us]"), "since": start.view("datetime64[us]"),
                    "state": np.where(at >= start + self.hold, "firing", "pending"), "samples": counts[1, sent],
                })
        if merge:
            self.remove(chunks)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        since, last = self.boundary.get() if self.boundary.exists() else (None, None)
        chunks = [c for c in self.stored() if c[0] < passed]
        for counts in self.sweep(chunks):
            end = int(np.searchsorted(counts[0], passed))
            if end:
                _, since, last = self.follow(since, last, counts[:, :end])
            self.put(counts[:, end:])
        self.remove(chunks)
        if last is not None:
            self.boundary.update((since, last))
        return iter([])

    def close(self) -> None:
        pass


class Cooldown(StatefulProcessor):
    """Trigger candidates (key, at) → those at least ``cooldown`` after the last one."""

    def __init__(self, cooldown_seconds: int):
        self.cooldown = cooldown_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for at in pd.concat(list(rows))["at"].sort_values():
            now = int(at.timestamp())
            if last is None or now - last >= self.cooldown:
                last = now
                out.append((key[0], at))
        if out:
            self.last.update((last,))
            yield pd.DataFrame(out, columns=["key", "at"])

    def close(self) -> None:
        pass


class Heartbeat(StatefulProcessor):
    """Heartbeats (source, at) → (source, absent_since) when none follows within the duration."""

    def __init__(self, duration_seconds: int):
        self.duration = duration_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(at.timestamp() * 1000) for part in rows for at in part["at"])
        before = self.last.get()[0] if self.last.exists() else None
        if before is None or newest > before:
            if before is not None:
                self.handle.deleteTimer(before + self.duration)
            self.last.update((newest,))
            self.handle.registerTimer(newest + self.duration)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        yield pd.DataFrame({"source": [key[0]], "absent_since": [since]})

    def close(self) -> None:
        pass


def held_stream(conditions: DataFrame, hold_seconds: int, step_seconds: int) -> DataFrame:
    """Streaming form of the pending/firing rule, keyed by ``alert``."""
    return conditions.groupBy("alert").transformWithStateInPandas(
        statefulProcessor=HeldCondition(hold_seconds, step_seconds),
        outputStructType="alert string, at timestamp, since timestamp, state string",
        outputMode="Append",
        timeMode="None",
    )


HELD_SCHEMA = "alert string, at timestamp, since timestamp, state string, samples bigint"


def held_runs(conditions: DataFrame, hold_seconds: int, step_seconds: int, watermark: str = "1 hour") -> DataFrame:
    """Pending/firing rule with late data, keyed by ``alert``: an update-mode stream for ``writers.upsert_log``."""
    return conditions.withWatermark("at", watermark).groupBy("alert").transformWithStateInPandas(
        statefulProcessor=HeldRuns(hold_seconds, step_seconds), outputStructType=HELD_SCHEMA, outputMode="Update", timeMode="EventTime",
    )


def cooldown_stream(candidates: DataFrame, cooldown_seconds: int) -> DataFrame:
    """Streaming form of the cooldown, keyed by ``key``."""
    return candidates.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Cooldown(cooldown_seconds),
        outputStructType="key string, at timestamp",
        outputMode="Append",
        timeMode="None",
    )


def absent_stream(heartbeats: DataFrame, duration_seconds: int, watermark: str = "10 minutes") -> DataFrame:
    """Sources without a heartbeat for the duration, by event-time timers."""
    return heartbeats.withWatermark("at", watermark).groupBy("source").transformWithStateInPandas(
        statefulProcessor=Heartbeat(duration_seconds),
        outputStructType="source string, absent_since timestamp",
        outputMode="Append",
        timeMode="EventTime",
    )


def dedup_stream(rows: DataFrame, key: str, ts: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    """Same content once within the watermark; state is dropped as the watermark passes."""
    return rows.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
