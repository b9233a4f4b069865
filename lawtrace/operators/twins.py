"""Comparing a clip with its lawful twin. Both tables are keyed by (clip_uid, body_id, frame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["clip_uid", "body_id", "frame"]
#: Channels in the order in which a first difference is reported.
CHANNELS = {"position": ("px", "py", "pz"), "rotation": ("qw", "qx", "qy", "qz"), "velocity": ("vx", "vy", "vz"), "spin": ("wx", "wy", "wz"), "scale": ("sx", "sy", "sz"), "colour": ("cr", "cg", "cb"), "opacity": ("opacity",)}
COLUMNS = [c for group in CHANNELS.values() for c in group]


def aligned(valid: DataFrame, invalid: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of both twins side by side, the invalid side's columns with a leading ``i_``: one co-located join. "full" keeps
    rows that one side lacks, with nulls for its ``present`` and all else."""
    right = invalid.select(*KEY, *[F.col(c).alias(f"i_{c}") for c in (*COLUMNS, "present")])
    return valid.join(right, KEY, how)


def _off(group: str):
    return F.greatest(*[F.abs(F.col(c) - F.col(f"i_{c}")) for c in CHANNELS[group]], F.lit(0.0))


def prefix_report(pairs: DataFrame, t_event: str = "t_event", tolerance: float = 0.0) -> DataFrame:
    """Per clip: whether all frames before the event agree, else the first channel that differs and the frame of its
    largest difference, the earliest on ties. Clips without earlier frames agree. Of pairs aligned in full, a clip whose sides
    have different numbers of bodies differs in "bodies", without a frame."""
    diffs = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(n).alias("channel"), _off(n).alias("diff")) for i, n in enumerate(CHANNELS)])
    d = pairs.where(F.col("frame") < F.col(t_event)).select("clip_uid", "frame", F.explode(diffs).alias("d")).where(F.col("d.diff") > tolerance)
    worst = d.groupBy("clip_uid", "d.rank", "d.channel").agg(F.max_by("frame", F.struct(F.col("d.diff"), -F.col("frame"))).alias("frame"))
    first = worst.groupBy("clip_uid").agg(F.min_by("channel", "rank").alias("channel"), F.min_by("frame", "rank").alias("frame"))
    bodies = [F.count_distinct(F.when(F.col(c).isNotNull(), F.col("body_id"))) for c in ("present", "i_present")]
    clips = pairs.groupBy("clip_uid").agg((bodies[0] != bodies[1]).alias("lost")).join(first, "clip_uid", "left")
    return clips.select("clip_uid", (~F.col("lost") & F.col("channel").isNull()).alias("identical"), F.when(F.col("lost"), "bodies").otherwise(F.col("channel")).alias("channel"), F.when(~F.col("lost"), F.col("frame")).alias("frame"))


def moved_bodies(pairs: DataFrame, least: float = 1e-3) -> DataFrame:
    """``(clip_uid, body_id, first_frame)`` of bodies whose position departs from the twin's, and when it first does."""
    return pairs.where(_off("position") > least).groupBy("clip_uid", "body_id").agg(F.min("frame").alias("first_frame"))


def diverged_frames(pairs: DataFrame, bodies: DataFrame, t_event: str = "t_event", least: float = 1e-3) -> DataFrame:
    """``(clip_uid, frame)`` from the event on where any listed body's position departs."""
    return pairs.join(bodies.select("clip_uid", "body_id"), ["clip_uid", "body_id"], "left_semi").where(F.col("frame") >= F.col(t_event)).where(_off("position") > least).select("clip_uid", "frame").distinct()


def disturbed(pairs: DataFrame, culprits: DataFrame, least: float = 1e-3) -> DataFrame:
    """Moved bodies that are no culprits."""
    return moved_bodies(pairs, least).join(culprits, ["clip_uid", "body_id"], "left_anti")


def dynamics_changed(pairs: DataFrame, culprits: DataFrame, least: float = 1e-9) -> DataFrame:
    """Per clip with culprits: whether any culprit's pose, velocities or presence differ."""
    off = F.greatest(*map(_off, ("position", "rotation", "velocity", "spin"))) > least
    own = pairs.join(culprits.select("clip_uid", "body_id"), ["clip_uid", "body_id"], "left_semi")
    return own.groupBy("clip_uid").agg(F.max(off | (F.col("present") != F.col("i_present"))).alias("changed"))


def undeclared(pairs: DataFrame, culprits: DataFrame, least: float = 1e-6) -> DataFrame:
    """Bodies whose scale, colour, opacity or presence differs though they are no declared culprits."""
    off = (F.greatest(*map(_off, ("scale", "colour", "opacity"))) > least) | (F.col("present") != F.col("i_present"))
    return pairs.groupBy("clip_uid", "body_id").agg(F.max(off).alias("changed")).where("changed").drop("changed").join(culprits, ["clip_uid", "body_id"], "left_anti")


def unchanged(pairs: DataFrame, least: float = 1e-6) -> DataFrame:
    """``(clip_uid)`` of pairs in which no body differs from its twin in any channel or in presence: an edit that did nothing."""
    off = (F.greatest(*map(_off, CHANNELS)) > least) | (F.col("present") != F.col("i_present"))
    return pairs.groupBy("clip_uid").agg(F.max(off).alias("changed")).where("not changed").select("clip_uid")


def contamination(valid: DataFrame, invalid: DataFrame, families: DataFrame, owners: DataFrame, leak: float = 1.0, moves: float = 0.1) -> DataFrame:
    """Every law against every family: which families move a law that is not theirs, and which owners do not move theirs.

    valid: (clip_uid, law, r); invalid: (family, clip_uid, law, r), each clip's twin for each family; families: (family); owners: (law, family), the
    exclusive laws. The rise of a law in a clip is its largest residual on the invalid side less that on the valid side. Of each (family, law): the largest
    rise of any clip, the clips whose rise is above ``leak``, and the verdict: "leak", if the law is exclusive, another family's, and some clip leaks;
    "silent", if the family owns the law and no clip rises above ``moves``; else "kept" for exclusive laws and "free" for others.
    """
    top = lambda t, n, *by: t.groupBy(*by, "clip_uid", "law").agg(F.max("r").alias(n))
    both = top(invalid, "most", "family").join(top(valid, "twin"), ["clip_uid", "law"]).withColumn("rise", F.col("most") - F.col("twin"))
    return verdicts(both, families, owners, leak, moves)


def verdicts(rises: DataFrame, families: DataFrame, owners: DataFrame, leak: float = 1.0, moves: float = 0.1) -> DataFrame:
    """The same from ``rises``, one row (family, law, rise) for each clip's twin."""
    risen = rises.groupBy("family", "law").agg(F.max("rise").alias("rise"), F.count_if(F.col("rise") > leak).alias("clips_over"))
    exclusive = owners.select("law").distinct().withColumn("exclusive", F.lit(True))
    own = owners.withColumn("owner", F.lit(True))
    t = families.join(risen, "family").join(F.broadcast(exclusive), "law", "left").join(F.broadcast(own), ["law", "family"], "left")  # a few fixed rows
    t = t.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("exclusive", "owner")})
    verdict = F.when(F.col("exclusive") & ~F.col("owner") & (F.col("clips_over") > 0), "leak").when(F.col("owner") & (F.col("rise") <= moves), "silent").when(F.col("exclusive"), "kept").otherwise("free")
    return t.select("family", "law", "rise", "clips_over", "exclusive", "owner", verdict.alias("verdict"))


def spliced(valid: DataFrame, tail: DataFrame, t0: str = "t0", columns: tuple[str, ...] = ("px", "py", "pz", "qw", "qx", "qy", "qz")) -> DataFrame:
    """The lawful rows before t0 and the replacement's from t0 on, for ``columns``; other channels stay lawful."""
    new = tail.select(*KEY, *[F.col(c).alias(f"n_{c}") for c in columns])
    late = F.col("frame") >= F.col(t0)
    return valid.join(new, KEY, "left").withColumns({c: F.when(late & F.col(f"n_{c}").isNotNull(), F.col(f"n_{c}")).otherwise(F.col(c)) for c in columns}).drop(*[f"n_{c}" for c in columns])


def spliced_contacts(valid: DataFrame, tail: DataFrame, events: DataFrame, t0: str = "t0") -> DataFrame:
    """The lawful contacts before each clip's t0 and the replacement's from it on. events: (clip_uid, t0); a clip without one keeps its lawful contacts."""
    early = valid.join(events, "clip_uid", "left").where(F.col(t0).isNull() | (F.col("frame") < F.col(t0))).select(*valid.columns)
    late = tail.join(events, "clip_uid").where(F.col("frame") >= F.col(t0)).select(*valid.columns)
    return early.unionByName(late)
