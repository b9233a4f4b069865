"""Masks, painted fields and token grids on sparse pixel tables.

A pixel row is (clip_uid, frame, y, x, body_id) and exists only for foreground; a mask is the set of its pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIXEL = ["clip_uid", "frame", "y", "x"]
FRAME = ["clip_uid", "frame"]
BODY = ["clip_uid", "body_id"]


def footprint(seg: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pixels of the listed bodies (clip_uid, body_id)."""
    return seg.join(bodies, BODY, "left_semi")


def sides(valid: DataFrame, invalid: DataFrame, bodies: DataFrame, colours: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Both twins pixel by pixel, with (in_v, in_i): whether a listed body owns the pixel on either side."""
    own = bodies.withColumn("own", F.lit(True))

    def side(t: DataFrame, s: str) -> DataFrame:
        t = t.join(own, BODY, "left")
        return t.select(*PIXEL, F.col("body_id").alias(f"body_{s}"), F.coalesce("own", F.lit(False)).alias(f"in_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in colours])

    both = side(valid, "v").join(side(invalid, "i"), PIXEL, "full_outer")
    return both.withColumns({f"in_{s}": F.coalesce(f"in_{s}", F.lit(False)) for s in "vi"})


def _difference(colours: tuple[str, ...]) -> Column:
    return F.greatest(*[F.abs(F.coalesce(f"{c}_v", F.lit(0)) - F.coalesce(f"{c}_i", F.lit(0))) for c in colours])


def observable_frames(both: DataFrame, level: int = 8, least: int = 4, colours: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Frames in which the twins disagree about the culprits: another footprint, or enough changed pixels inside it.

    Pass dynamic culprits only to ``sides``: a body that sinks into a listed floor would leave the union unchanged."""
    inside = both.where("in_v or in_i")
    changed = (F.col("body_v").isNotNull() & F.col("body_i").isNotNull() & (_difference(colours) >= level)).cast("int")
    seen = inside.groupBy(*FRAME).agg(F.max(F.col("in_v") != F.col("in_i")).alias("occupancy"), F.sum(changed).alias("changed"))
    return seen.where(F.col("occupancy") | (F.col("changed") >= least)).select(*FRAME)


def divergence(both: DataFrame, colours: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Largest channel difference of each pixel as a share of 255; background is black."""
    return both.select(*PIXEL, (_difference(colours) / 255.0).alias("divergence")).where("divergence > 0")


def prefix_differences(both: DataFrame, events: DataFrame, colours: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Channels that differ before the event, summed over pixels; clips without any are 0."""
    off = sum(F.when(F.coalesce(f"{c}_v", F.lit(0)) != F.coalesce(f"{c}_i", F.lit(0)), 1).otherwise(0) for c in colours)
    early = both.join(events, "clip_uid").where(F.col("frame") < F.col("t_event"))
    found = early.groupBy("clip_uid").agg(F.sum(off).alias("differences"))
    return events.select("clip_uid").join(found, "clip_uid", "left").withColumn("differences", F.coalesce("differences", F.lit(0)))


def occluded_frames(frames: DataFrame, seg: DataFrame, body: Column) -> DataFrame:
    """Frames in which the body has no pixel."""
    return frames.join(seg.where(F.col("body_id") == body).select(*FRAME).distinct(), FRAME, "left_anti")


def violation_mask(valid: DataFrame, invalid: DataFrame, gate: DataFrame) -> DataFrame:
    """Union of both twins' footprints on the gated frames."""
    return valid.select(*PIXEL).unionByName(invalid.select(*PIXEL)).join(gate, FRAME, "left_semi").distinct()


def outside(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Pixels of ``part`` that are not in ``whole``: empty if it is a subset."""
    return part.join(whole, PIXEL, "left_anti")


def dilated(mask: DataFrame, k: int, height: int, width: int) -> DataFrame:
    """Square dilation by ``k`` that wraps at the edges. The places of a frame, ``height`` times ``width`` at most, are one list, spread along y and
    then along x, so that no table of spread rows has to be made distinct."""
    def spread(places: Column, to) -> Column:
        return F.array_distinct(F.flatten(F.transform(places, lambda p: F.transform(F.sequence(F.lit(-k), F.lit(k)), lambda d: to(F.floor(p / width).cast("int"), p % width, d)))))

    place = (F.pmod(F.col("y"), F.lit(height)) * width + F.pmod(F.col("x"), F.lit(width))).cast("int")
    held = mask.groupBy(*FRAME).agg(F.collect_set(place).alias("places"))
    along = held.select(*FRAME, spread(F.col("places"), lambda y, x, d: F.pmod(y + d, F.lit(height)) * width + x).alias("places"))
    wide = along.select(*FRAME, F.explode(spread(F.col("places"), lambda y, x, d: y * width + F.pmod(x + d, F.lit(width)))).alias("place"))
    return wide.select(*FRAME, F.floor(F.col("place") / width).cast("int").alias("y"), (F.col("place") % width).alias("x"))


def causal_levels(seg: DataFrame, roles: DataFrame, height: int, width: int, k: int = 3) -> DataFrame:
    """1 on culprits, 2 on moving secondaries anywhere and on static ones within ``k`` pixels of a culprit.

    roles: (clip_uid, body_id, role) with culprit, moving or static."""
    t = seg.join(roles, BODY)
    culprit = t.where("role = 'culprit'").select(*PIXEL)
    near = t.where("role = 'static'").select(*PIXEL).join(dilated(culprit, k, height, width), PIXEL, "left_semi")
    second = t.where("role = 'moving'").select(*PIXEL).unionByName(near)
    return culprit.withColumn("level", F.lit(1)).unionByName(second.withColumn("level", F.lit(2))).groupBy(*PIXEL).agg(F.min("level").alias("level"))


def painted(seg: DataFrame, values: DataFrame, value: str = "score", gate: DataFrame | None = None) -> DataFrame:
    """Each pixel takes the value of its body at its frame; zero elsewhere is left out."""
    out = seg.join(values.select("clip_uid", "frame", "body_id", value), ["clip_uid", "frame", "body_id"])
    out = out if gate is None else out.join(gate, FRAME, "left_semi")
    return out.select(*PIXEL, value).where(F.col(value) != 0)


def painted_everywhere(frames: DataFrame, height: int, width: int, value: str = "score") -> DataFrame:
    """A value of the whole frame on every pixel."""
    rows = frames.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    return rows.select(*PIXEL, value)


def with_vanished(field: DataFrame, reference: DataFrame, invalid_mask: DataFrame, absent: DataFrame, value: str = "score") -> DataFrame:
    """Adds the reference footprint where a culprit is absent (``absent``: clip_uid, frame, and the value to paint) and
    the invalid side shows nothing of it; pixels already painted stay."""
    blind = absent.join(invalid_mask.select(*FRAME).distinct(), FRAME, "left_anti")
    extra = reference.select(*PIXEL).distinct().join(blind, FRAME).select(*PIXEL, value).join(field, PIXEL, "left_anti")
    return field.unionByName(extra)


def visibility(bodies: DataFrame, seg: DataFrame) -> DataFrame:
    """First and last frame, frames visible and peak pixels of every body; zeros for one never seen."""
    per = seg.groupBy(*BODY, "frame").agg(F.count("*").alias("n"))
    seen = per.groupBy(*BODY).agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.count("*").alias("frames_visible"), F.max("n").alias("peak_pixels"))
    return bodies.join(seen, BODY, "left").na.fill(0, ["frames_visible", "peak_pixels"])


def mask_summary(clips: DataFrame, mask: DataFrame) -> DataFrame:
    """Frames with pixels, peak pixels and its first frame; an empty mask peaks at frame 0, a clip without frames at -1.

    clips: (clip_uid, frames)."""
    per = mask.groupBy(*FRAME).agg(F.count("*").alias("n"))
    found = per.groupBy("clip_uid").agg(F.count("*").alias("frames_nonempty"), F.max("n").alias("peak_pixels"), F.max_by("frame", F.struct(F.col("n"), -F.col("frame"))).alias("peak_frame"))
    out = clips.join(found, "clip_uid", "left").na.fill(0, ["frames_nonempty", "peak_pixels"])
    return out.withColumn("peak_frame", F.when(F.col("frames") == 0, -1).otherwise(F.coalesce("peak_frame", F.lit(0)))).drop("frames")


def profile(frames: DataFrame, field: DataFrame, value: str = "score") -> DataFrame:
    """Largest value of every frame, zero where nothing is painted."""
    top = field.groupBy(*FRAME).agg(F.max(value).alias(value))
    return frames.join(top, FRAME, "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def measured(clips: DataFrame, field: DataFrame, observable: DataFrame, mask: DataFrame, diverged: DataFrame) -> DataFrame:
    """Per clip: peak severity, observable frames, and evidence, the largest divergence inside the mask."""
    top = field.groupBy("clip_uid").agg(F.max("score").alias("peak_severity"))
    seen = observable.groupBy("clip_uid").agg(F.countDistinct("frame").alias("observable_frames"))
    proof = mask.join(diverged, PIXEL).groupBy("clip_uid").agg(F.max("divergence").alias("evidence"))
    out = clips.join(top, "clip_uid", "left").join(seen, "clip_uid", "left").join(proof, "clip_uid", "left")
    return out.na.fill(0.0, ["peak_severity", "evidence"]).na.fill(0, ["observable_frames"])


INVISIBLE = "peak_severity < 0.02 and observable_frames < 1 and evidence < 0.02"
UNSCORED = "evidence >= 0.02 and peak_severity < 0.02"


def token_grid(mask: DataFrame, field: DataFrame, frames: int, height: int, width: int, side: int, value: str = "score") -> DataFrame:
    """``(clip_uid, f_lat, h_lat, w_lat, hit, peak, mean)`` of every latent cell that holds a pixel.

    The first latent frame is frame 0, the i-th is frames 4i - 3 to 4i, so ``frames`` must be 4k + 1; space is cut into
    ``side`` by ``side`` exact blocks. The mean is over each frame's block and then over the cell's frames, with
    unpainted pixels as zero, from sums and the cell's volume rather than rows for zeros.
    """
    if frames % 4 != 1 or height % side or width % side:
        raise ValueError(f"{frames} frames of {height} x {width} do not divide into 4k + 1 frames and {side} x {side} blocks")
    bh, bw = height // side, width // side
    cell = [F.ceil(F.col("frame") / 4).cast("int").alias("f_lat"), F.floor(F.col("y") / bh).cast("int").alias("h_lat"), F.floor(F.col("x") / bw).cast("int").alias("w_lat")]
    rows = mask.select(*PIXEL, F.lit(True).alias("hit"), F.lit(None).cast("double").alias("v")).unionByName(field.select(*PIXEL, F.lit(False).alias("hit"), F.col(value).cast("double").alias("v")))
    volume = F.when(F.col("f_lat") == 0, 1).otherwise(4) * (bh * bw)
    out = rows.select("clip_uid", *cell, "hit", "v").groupBy("clip_uid", "f_lat", "h_lat", "w_lat").agg(F.max("hit").alias("hit"), F.coalesce(F.max("v"), F.lit(0.0)).alias("peak"), F.coalesce(F.sum("v"), F.lit(0.0)).alias("s"))
    return out.withColumn("mean", F.col("s") / volume).drop("s")


def dense_grid(clips: DataFrame, grid: DataFrame, frames: int, side: int) -> DataFrame:
    """Every cell of every clip, zeros included."""
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = clips.select("clip_uid").withColumn("f_lat", steps((frames - 1) // 4 + 1)).withColumn("h_lat", steps(side)).withColumn("w_lat", steps(side))
    out = cells.join(grid, ["clip_uid", "f_lat", "h_lat", "w_lat"], "left")
    return out.withColumn("hit", F.coalesce("hit", F.lit(False))).na.fill(0.0, ["peak", "mean"])
