"""Frames and intervals: intervals are inclusive at both ends; a clip's frames run from 0 to T - 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rasterised(frames: DataFrame, windows: DataFrame, key: list[str], start: str = "s", end: str = "e", name: str = "active") -> DataFrame:
    """``frames`` with ``name``: whether any window of its key holds the frame. Windows are gathered by key first, so
    frames are never multiplied."""
    held = windows.groupBy(*key).agg(F.collect_list(F.struct(F.col(start).alias("s"), F.col(end).alias("e"))).alias("held"))
    return frames.join(held, key, "left").withColumn(name, F.coalesce(F.exists("held", lambda w: (F.col("frame") >= w["s"]) & (F.col("frame") <= w["e"])), F.lit(False))).drop("held")


def within(windows: Column, frame: Column) -> Column:
    """The same for an array column of (s, e)."""
    return F.coalesce(F.exists(windows, lambda w: (frame >= w["s"]) & (frame <= w["e"])), F.lit(False))


def islands(rows: DataFrame, key: list[str], flag: str) -> DataFrame:
    """``key`` with (s, e) of every maximal run of frames where ``flag`` holds."""
    by = Window.partitionBy(*key).orderBy("frame")
    runs = rows.where(flag).withColumn("island", F.col("frame") - F.row_number().over(by))
    return runs.groupBy(*key, "island").agg(F.min("frame").alias("s"), F.max("frame").alias("e")).drop("island")


def as_windows(rows: DataFrame, key: list[str], flag: str) -> DataFrame:
    """``key`` with its runs as one ordered array."""
    return islands(rows, key, flag).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("windows"))


def widened(flag: Column, key: list[str], slack: int) -> Column:
    """True within ``slack`` frames of a true one; never past the clip's ends. Frames must be dense."""
    by = Window.partitionBy(*key).orderBy("frame").rowsBetween(-slack, slack)
    return F.coalesce(F.max(flag).over(by), F.lit(False))


def widened_round(flag: Column, key: list[str], slack: int, last: Column) -> Column:
    """The same with the clip's end joined to its start."""
    by = Window.partitionBy(*key).orderBy("frame")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = [F.max(flag & (F.col("frame") > last - slack + i)).over(whole) & (F.col("frame") == i) for i in range(slack)]
    starts = [F.max(flag & (F.col("frame") < slack - i)).over(whole) & (F.col("frame") == last - i) for i in range(slack)]
    out = widened(flag, key, slack)
    for c in (*ends, *starts):
        out = out | F.coalesce(c, F.lit(False))
    return out


def longest_run(rows: DataFrame, key: list[str], flag: str, least: int = 1) -> DataFrame:
    """(s, e) of the longest run of each key, the first of equals; runs shorter than ``least`` do not count."""
    runs = islands(rows, key, flag).withColumn("len", F.col("e") - F.col("s") + 1).where(F.col("len") >= least)
    best = F.struct(F.col("len"), -F.col("s"))
    return runs.groupBy(*key).agg(F.max_by("s", best).alias("s"), F.max_by("e", best).alias("e"), F.max("len").alias("len"))


def attributed(rows: DataFrame, key: list[str], score: str = "score", active: str = "active", observable: str = "observable") -> DataFrame:
    """``rows`` with (gate, placed): severity moved to the frames that show it.

    In a run of active frames the largest score since the last observable frame stands at each observable frame. A run
    without one spills its largest score to the first observable frame after it that comes before the next run. What is
    never observable gives nothing. Windows only: runs, then groups between observable frames, then a look ahead.
    """
    by = Window.partitionBy(*key).orderBy("frame")
    a, o = F.col(active), F.col(observable)
    t = rows.withColumn("run", F.sum((a & ~F.coalesce(F.lag(a).over(by), F.lit(False))).cast("int")).over(by))
    inside = Window.partitionBy(*key, "run", active).orderBy("frame")
    t = t.withColumn("part", F.coalesce(F.sum(o.cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    piece = Window.partitionBy(*key, "run", active, "part")
    all_of = Window.partitionBy(*key, "run")
    carried = F.greatest(F.max(score).over(piece), F.lit(0.0))
    t = t.withColumns({"carried": carried, "seen": F.max(a & o).over(all_of), "whole": F.greatest(F.max(F.when(a, F.col(score))).over(all_of), F.lit(0.0)), "first_after": F.min(F.when(~a & o, F.col("frame"))).over(all_of)})
    here = a & o
    spill = ~a & o & (F.col("run") > 0) & ~F.col("seen") & (F.col("frame") == F.col("first_after"))
    t = t.withColumn("gate", F.coalesce(here | spill, F.lit(False))).withColumn("placed", F.when(here, F.col("carried")).when(spill, F.col("whole")).otherwise(0.0))
    return t.select(*rows.columns, "gate", "placed")


def gain_windows(rows: DataFrame, key: list[str], flag: str, t0: str = "t0") -> DataFrame:
    """Two-frame windows taken greedily over the flagged frames of each key from t0 on, with one forced at t0, joined where they touch.

    rows: key, frame, flag and t0, one row for each frame; of several targets the flag is whether any gains. A run of L flagged frames from
    s is covered by ceil(L / 2) windows, up to s + 2 ceil(L / 2) - 1; covers that touch or overlap join. No window passes the last frame.
    """
    ends = rows.groupBy(*key).agg(F.max("frame").alias("last"), F.max(t0).alias("start"))
    runs = islands(rows.withColumn("late", F.col(flag) & (F.col("frame") >= F.col(t0))), key, "late").join(ends, key)
    cover = runs.select(*key, "s", F.least(F.col("s") + 2 * F.ceil((F.col("e") - F.col("s") + 1) / 2) - 1, "last").alias("e"))
    forced = ends.select(*key, F.col("start").alias("s"), F.least(F.col("start") + 1, F.col("last")).cast("long").alias("e"))
    by = Window.partitionBy(*key).orderBy("s", "e")
    before = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    t = cover.unionByName(forced).withColumn("fresh", (before.isNull() | (F.col("s") > before + 1)).cast("int")).withColumn("g", F.sum("fresh").over(by))
    return t.groupBy(*key, "g").agg(F.min("s").alias("s"), F.max("e").cast("int").alias("e")).drop("g")


def split_window(t0: Column, frames: Column, n: Column) -> Column:
    """(violation, intervention, consequence) of a change made for ``n`` frames from ``t0`` that then stays."""
    last = frames - 1
    end = F.least(last, t0 + F.greatest(F.lit(1), n) - 1)
    pair = lambda s, e: F.struct(s.alias("s"), e.alias("e"))
    return F.struct(pair(t0, last).alias("violation"), pair(t0, end).alias("intervention"), pair(t0, last).alias("consequence"))


def frames_for(seconds: Column, fps: float, least: int = 2) -> Column:
    """Seconds as frames, rounded half to even."""
    return F.greatest(F.lit(least), F.bround(seconds * fps).cast("int"))


def overlap(a: str, b: str) -> list[Column]:
    """Aggregates comparing two flags over frames: latency of the first frame of b after a's, and duration IoU."""
    both, either = F.count_if(F.col(a) & F.col(b)), F.count_if(F.col(a) | F.col(b))
    start = lambda c: F.min(F.when(F.col(c), F.col("frame")))
    return [(start(b) - start(a)).alias("latency"), F.when(either > 0, both / either).alias("iou")]
