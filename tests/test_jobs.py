"""Cooldown over blocks, snapshots by pointer, stored-once and late-data streams."""

import os
import random
import weakref
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievemark.sources import readers, writers
from sievemark.streaming import alerts, stateful

BASE = datetime(2024, 1, 1)


def cooled(times, hold):
    out = []
    for t in sorted(set(times)):
        if not out or t - out[-1] >= hold:
            out.append(t)
    return out


def test_cooldown_over_blocks(spark):
    rng = random.Random(1)
    hold = 7
    keys = {"dense": [rng.randrange(3000) for _ in range(2500)], "sparse": [rng.randrange(9000) for _ in range(40)], None: list(range(-500, 2000, 3)), "late": [449, 450, 8000]}
    rows = [(k, t) for k, ts in keys.items() for t in ts]
    df = spark.createDataFrame(rows, "job string, s long").select("job", F.timestamp_seconds("s").alias("at"))
    got = {}
    for r in alerts.cooled_triggers(df, ["job"], cooldown=f"{hold} seconds").select("job", F.unix_timestamp("at").alias("s")).collect():
        got.setdefault(r.job, []).append(r.s)
    assert {k: sorted(v) for k, v in got.items()} == {k: cooled(ts, hold) for k, ts in keys.items()}


def test_cooldown_of_one_key_without_a_gap(spark):
    n, hold = 1_000_000, 50
    df = spark.range(0, n, 1, 8).select(F.lit("j").alias("job"), F.timestamp_seconds(F.col("id") * 3).alias("at"))
    out = alerts.cooled_triggers(df, ["job"], cooldown=f"{hold} seconds")
    row = out.agg(F.count("*").alias("n"), F.min(F.unix_timestamp("at")).alias("a"), F.max(F.unix_timestamp("at")).alias("z")).first()
    wanted = np.arange(0, 3 * n, 51)
    assert (row.n, row.a, row.z) == (len(wanted), wanted[0], wanted[-1])


def test_block_exits():
    rng = random.Random(2)
    for _ in range(50):
        times, hold = np.array(sorted(rng.sample(range(300), 60))), rng.randrange(1, 40)
        for i, leave in enumerate(alerts.block_exits(times, hold)):
            assert leave == cooled(times[i:].tolist(), hold)[-1] + hold


def test_snapshot_by_pointer(spark, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        readers.current_snapshot(spark, root)
    writers.write_snapshot(spark.range(3), root, "2024-01-01")
    reader = readers.current_snapshot(spark, root)  # begins before the next write, ends after it
    writers.write_snapshot(spark.range(5), root, "2024-01-01")
    assert reader.count() == 3 and readers.current_snapshot(spark, root).count() == 5
    broken = spark.range(4).select(F.raise_error(F.lit("killed")).cast("string").alias("id"))
    with pytest.raises(Exception, match="killed"):
        writers.write_snapshot(broken, root, "2024-01-02")
    (tmp_path / "s" / "_current" / f"{3:012d}").mkdir()  # a pointer whose write has not ended
    assert readers.current_snapshot(spark, root).count() == 5


def test_class_report_with_null_class(spark, tmp_path):
    rows = spark.createDataFrame([("a", 3, 1), (None, 2, None)], "species string, total long, kept long")
    writers.write_class_report(rows, "species", str(tmp_path / "r"))
    got = readers.class_report_json(spark, str(tmp_path / "r"), "total bigint, kept bigint").collect()
    assert sorted(map(tuple, got), key=str) == [("a", 3, 1), (None, 2, None)]


def files(spark, folder, parts, schema):
    """One Parquet file after the other, dated so that a stream takes them in this order."""
    os.makedirs(folder)
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}-{i}")
        (written,) = Path(f"{folder}-{i}").glob("*.parquet")
        written.rename(f"{folder}/{i}.parquet")
        os.utime(f"{folder}/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))


def test_stored_once(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    files(spark, folder, [[("a",), ("b",), ("a",), (None,)], [("b",), ("c",)], [("a",), (None,), ("d",)]], "image_hash string")
    stream = spark.readStream.schema("image_hash string").option("maxFilesPerTrigger", 1).parquet(folder)
    writers.store_once(stream, "image_hash", root, str(tmp_path / "c1")).awaitTermination()
    got = sorted((r.image_hash for r in spark.read.parquet(root).collect()), key=str)
    assert got == sorted(["a", "b", "c", "d", None], key=str)
    # without its checkpoint every batch is replayed: nothing is added or lost
    writers.store_once(stream, "image_hash", root, str(tmp_path / "c2")).awaitTermination()
    assert sorted((r.image_hash for r in spark.read.parquet(root).collect()), key=str) == got


def held(rows, hold, step):
    """(alert, at, since, state) of every active sample, in order of time; inactive ones of a time last."""
    out = []
    for alert in {r[0] for r in rows}:
        since = last = None
        for _, at, active in sorted((r for r in rows if r[0] == alert), key=lambda r: (r[1], not r[2])):
            if active:
                since = at if since is None or (at - last).total_seconds() > step else since
                out.append((alert, at, since, "firing" if (at - since).total_seconds() >= hold else "pending"))
            else:
                since = None
            last = at
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 6])
def test_held_runs_do_not_depend_on_batches(spark, tmp_path, parts):
    stateful.use_rocksdb(spark)
    rng = random.Random(3)
    rows = [(rng.choice("xy"), BASE + timedelta(minutes=rng.randrange(300), microseconds=rng.choice([0, 0, 7])), rng.random() < 0.8) for _ in range(240)]
    # arrival out of order by less than the watermark
    rows.sort(key=lambda r: (r[1] + timedelta(minutes=rng.randrange(50)), r[0]))
    size = -(-len(rows) // parts)
    folder = str(tmp_path / "in")
    schema = "alert string, at timestamp, active boolean"
    files(spark, folder, [rows[i : i + size] for i in range(0, len(rows), size)], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    root = str(tmp_path / "out")
    writers.upsert_log(stateful.held_runs(stream, 600, 240, "1 hour"), root, str(tmp_path / "c")).awaitTermination()
    got = readers.latest_rows(spark, root, stateful.HELD_SCHEMA, ["alert", "at"]).collect()
    assert sorted((r.alert, r.at, r.since, r.state) for r in got for _ in range(r.samples)) == held(rows, 600, 240)


class Cells:
    """State of one key in a plain dictionary."""

    def __init__(self):
        self.values, self.timers = {}, []

    def getValueState(self, name, schema):
        cell = Cells()
        cell.exists, cell.get, cell.update = lambda: None in cell.values, lambda: cell.values[None], lambda v: cell.values.update({None: v})
        return cell

    def getMapState(self, name, *schemas):
        cell = Cells()
        cell.containsKey, cell.getValue, cell.removeKey = cell.values.__contains__, cell.values.__getitem__, cell.values.pop
        cell.updateValue, cell.keys, cell.iterator = cell.values.__setitem__, lambda: iter(list(cell.values)), lambda: iter(list(cell.values.items()))
        return cell

    def registerTimer(self, at):
        self.timers.append(at)


def test_held_runs_hold_no_key_whole(monkeypatch):
    for name, value in {"SORTED": 2000, "CHUNK": 100, "DEPTH": 4}.items():
        monkeypatch.setattr(stateful.HeldRuns, name, value, raising=False)
    rng = random.Random(5)
    rows = [("x", BASE + timedelta(seconds=rng.randrange(100_000), microseconds=rng.choice([0, 0, 7])), rng.random() < 0.97) for _ in range(30_000)]
    rows.sort(key=lambda r: r[1] + timedelta(minutes=rng.randrange(50)))
    first, *late = [rows[:20_000], *(rows[i : i + 250] for i in range(20_000, 30_000, 250))]
    rng.shuffle(first)
    handle, processor, got, alive, most, longest = Cells(), stateful.HeldRuns(600, 30), {}, [], 0, 0

    def frames(batch):
        nonlocal most
        for i in range(0, len(batch), 250):
            frame = pd.DataFrame(batch[i : i + 250], columns=["alert", "at", "active"])
            alive.append(weakref.ref(frame))
            yield frame
            del frame
            alive[:] = [r for r in alive if r() is not None]
            most = max(most, len(alive))

    processor.init(handle)
    passed = BASE
    for number, batch in enumerate([first, *late]):
        for frame in processor.handleInputRows(("x",), frames([r for r in batch if r[1] >= passed]), None):
            longest = max(longest, len(frame))
            got.update({r.at: (r.at, r.since, r.state, r.samples) for r in frame.itertuples()})
        if number % 3 == 0:  # the watermark moves on
            passed = max(r[1] for r in batch) - timedelta(hours=1)
            since_1970 = (passed - datetime(1970, 1, 1)) // timedelta(milliseconds=1)
            watermark = SimpleNamespace(getCurrentWatermarkInMs=lambda at=since_1970: at)
            assert not list(processor.handleExpiredTimer(("x",), watermark, None))
    expanded = [("x", at, since, state) for at, since, state, samples in got.values() for _ in range(samples)]
    assert sorted(expanded) == held(rows, 600, 30)
    assert most < 20 and longest < 8000
    assert len(processor.chunks.values) < 400
