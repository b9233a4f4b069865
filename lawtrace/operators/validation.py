"""Validation rules over clip records and their tables: one row (clip_uid, rule) for each violated rule.

A rule is a name and a condition that holds for bad rows. A clip with an unknown family is reported for that alone, a valid clip is
not asked about its violation, and a clip that lacks an annotation table is not asked about its annotations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.operators import taxonomy


def record_rules() -> dict[str, Column]:
    """Rules on one record with its family joined (known_*): true where violated."""
    c, v = F.col, "violation."
    windows = c(f"{v}violation_windows")
    ends, starts = F.transform(windows, lambda w: w["e"]), F.transform(windows, lambda w: w["s"])
    covered = lambda f: F.exists(windows, lambda w: (f >= w["s"]) & (f <= w["e"]))
    inside = F.forall(c(f"{v}intervention_windows"), lambda i: F.forall(F.sequence(i["s"], F.greatest(i["s"], i["e"])), covered))
    invalid = c("label") == "invalid"
    return {
        "family unknown": c("known_domain").isNull(),
        "scenario unknown": c("known_medium").isNull(),
        "domain differs": c("domain") != c("known_domain"),
        "cell not in matrix": c("known_cell").isNull(),
        "medium": (c("physics_medium") == "fluid") | ((c("physics_medium") == "granular") != (c("scenario") == "pour")),
        "asset without licence": F.exists("assets", lambda a: F.coalesce(a["license"], F.lit("")) == ""),
        "prefix differs": ~F.coalesce(c("prefix_identical"), F.lit(False)),
        "energy not finite": c("energy_total").isNull() | F.isnan("energy_total") | (F.abs("energy_total") == float("inf")),
        "valid clip gains energy": (c("label") == "valid") & (c("energy_anomaly") > 0.01),
        "violation iff invalid": (c("label") == "invalid") != c("violation").isNotNull(),
        "intervention outside": invalid & ~inside,
        "frames out of order": invalid & ((c(f"{v}t_observable_frame") < c(f"{v}t_event_frame")) | (c(f"{v}t_end_frame") < c(f"{v}t_event_frame"))),
        "windows bad": invalid & ((F.size(windows) == 0) | F.exists(windows, lambda w: (w["s"] > w["e"]) | (w["s"] < 0) | (w["e"] >= c("num_frames"))) | (F.size(windows) > 1) & F.exists(F.sequence(F.lit(1), F.greatest(F.size(windows) - 1, F.lit(1))), lambda i: F.coalesce(F.get(windows, i)["s"] <= F.get(windows, i - 1)["e"], F.lit(False)))),
        "extremes differ": invalid & ((F.array_min(starts) != c(f"{v}t_event_frame")) | (F.array_max(ends) != c(f"{v}t_end_frame"))),
        "extent": invalid & ((c(f"{v}spatial_extent") == "global") != (c("family") == "global_gravity")),
        "culprit not declared": invalid & (F.size(F.array_except(f"{v}causal_body_ids", F.transform("instances", lambda b: b["body_id"]))) > 0),
    }


def violations(records: DataFrame) -> DataFrame:
    """``(clip_uid, rule)``: one pass over the records; the dimensions are fixed small tables."""
    spark = records.sparkSession
    fam = taxonomy.families(spark).select("family", F.col("domain").alias("known_domain"))
    scen = taxonomy.scenarios(spark).select("scenario", F.col("medium").alias("known_medium"))
    # the cells are fixed, so they are one literal list and not a product of dimensions made anew for each call
    known = F.when(F.concat_ws("/", "family", "scenario").isin(*[f"{f}/{s}" for f, s in taxonomy.cells()]), "cell")
    t = records.join(F.broadcast(fam), "family", "left").join(F.broadcast(scen), "scenario", "left").withColumn("known_cell", known)
    rules = record_rules()
    stop = rules["family unknown"]
    found = F.array(*[F.when(cond if name == "family unknown" else cond & ~stop, F.lit(name)) for name, cond in rules.items()])
    return t.select("clip_uid", F.explode(F.array_compact(found)).alias("rule"))


def unlicensed(records: DataFrame) -> DataFrame:
    """``(clip_uid, rule, asset)``: one row for each asset without a licence, by its place among the clip's assets."""
    each = records.select("clip_uid", F.posexplode("assets").alias("asset", "a"))
    return each.where(F.coalesce("a.license", F.lit("")) == "").select("clip_uid", F.lit("asset without licence").alias("rule"), "asset")


CHANNELS = ("contact_anomaly", "free_anomaly", "excess_loss")


def energy_violations(labels: DataFrame, trace: DataFrame, by_body: DataFrame, tolerance: float = 1e-3, limit: float = 0.01) -> DataFrame:
    """``(clip_uid, rule)`` of energies: a total that is not finite; bodies whose sum is off the total by more than ``tolerance`` of the first frame's; on
    valid clips a channel, as a share of the first frame's, above ``limit``.

    labels: (clip_uid, label); trace: (clip_uid, frame, total, ``CHANNELS``); by_body: (clip_uid, frame, body_id, energy)."""
    sums = by_body.groupBy("clip_uid", "frame").agg(F.sum("energy").alias("s"))
    finite = F.col("total").isNotNull() & ~F.isnan("total") & (F.abs("total") < float("inf"))
    g = trace.join(sums, ["clip_uid", "frame"], "left").groupBy("clip_uid").agg(
        F.max(~finite).alias("broken"), F.max(F.abs(F.coalesce("s", F.lit(0.0)) - F.col("total"))).alias("drift"), F.min_by(F.abs("total"), "frame").alias("e0"), *[F.max(c).alias(c) for c in CHANNELS],
    )
    g = g.join(labels, "clip_uid")
    rules = [F.when(F.col("broken"), F.lit("energy not finite")), F.when(~F.col("broken") & (F.col("drift") > tolerance * F.greatest(F.col("e0"), F.lit(1e-9))), F.lit("energy by body differs"))]
    rules += [F.when((F.col("label") == "valid") & (F.col(c) > limit), F.lit(f"valid clip: {c}")) for c in CHANNELS]
    return g.select("clip_uid", F.explode(F.array_compact(F.array(*rules))).alias("rule"))


def part_violations(parts: DataFrame, masks: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``(clip_uid, rule)`` of clips whose invalid-side mask holds a pixel that the violation mask lacks, or whose masks differ in size.

    sizes: (clip_uid, part_size, mask_size), each a struct of frames, height and width; a clip of two sizes is reported for that alone."""
    from lawtrace.operators.pixels import outside

    out = outside(parts.select("clip_uid", "frame", "y", "x"), masks).select("clip_uid").distinct().withColumn("rule", F.lit("mask outside the union"))
    if sizes is None:
        return out
    other = sizes.where(~F.col("part_size").eqNullSafe(F.col("mask_size"))).select("clip_uid", F.lit("masks differ in size").alias("rule"))
    return out.join(other, "clip_uid", "left_anti").unionByName(other)


def annotation_violations(records: DataFrame, timelines: DataFrame, masks: DataFrame, severities: DataFrame, held: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """``(clip_uid, frame, rule)`` of the annotations of clips with a violation.

    held: (clip_uid, name) of the tables that a clip has; one without its timelines, violation_mask or severity_map is reported once, without a
    frame, and stops there. Of the others: both flags of their timelines against the rastered windows, masks and severities by frame.
    records: (clip_uid, violation_windows, observable_windows); timelines: (clip_uid, frame, active, observable, severity); severities: (clip_uid, frame, score).
    """
    from lawtrace.operators.intervals import within

    needed = F.array(*[F.lit(n) for n in ("timelines", "violation_mask", "severity_map")])
    has = held.groupBy("clip_uid").agg(F.collect_set("name").alias("names"))
    t = records.join(has, "clip_uid", "left").withColumn("whole", F.size(F.array_except(needed, F.coalesce("names", F.array().cast("array<string>")))) == 0)
    absent = t.where(~F.col("whole")).select("clip_uid", F.lit(None).cast("int").alias("frame"), F.lit("annotation missing").alias("rule"))
    lines = timelines.join(t.where("whole").select("clip_uid", "violation_windows", "observable_windows"), "clip_uid")
    differs = lambda flag: F.col(flag) != within(F.col(f"{'violation' if flag == 'active' else 'observable'}_windows"), F.col("frame"))
    flags = F.array_compact(F.array(*[F.when(differs(f), F.lit(f"{f} differs")) for f in ("active", "observable")]))
    found = lines.select("clip_uid", "frame", F.explode(flags).alias("rule"))
    found = found.unionByName(mask_violations(lines, masks)).unionByName(profile_violations(severities, lines, tolerance))
    return absent.unionByName(found)


def timeline_violations(windows: DataFrame, timelines: DataFrame) -> DataFrame:
    """Frames whose active flag is not what the windows (clip_uid, s, e) rasterise to."""
    from lawtrace.operators.intervals import rasterised

    both = rasterised(timelines, windows, ["clip_uid"], name="expected")
    return both.where(F.col("expected") != F.col("active")).select("clip_uid", "frame").withColumn("rule", F.lit("timeline differs"))


def mask_violations(timelines: DataFrame, mask: DataFrame) -> DataFrame:
    """Active frames whose mask is empty though observable, or not empty though not observable."""
    n = mask.groupBy("clip_uid", "frame").agg(F.count("*").alias("n"))
    t = timelines.join(n, ["clip_uid", "frame"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bad = F.when(F.col("observable") & (F.col("n") == 0), "mask empty").when(~F.col("observable") & (F.col("n") > 0), "mask where nothing shows")
    return t.where("active").withColumn("rule", bad).where("rule is not null").select("clip_uid", "frame", "rule")


def profile_violations(profile: DataFrame, timelines: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Frames whose recorded severity is not the largest of the map."""
    both = timelines.join(profile.withColumnRenamed("score", "largest"), ["clip_uid", "frame"])
    return both.where(F.abs(F.col("severity") - F.col("largest")) > tolerance).select("clip_uid", "frame").withColumn("rule", F.lit("severity differs"))


def disordered_windows(windows: DataFrame) -> DataFrame:
    """Windows (clip_uid, s, e) that do not start after the one before them ends."""
    before = F.lag("e").over(Window.partitionBy("clip_uid").orderBy("s", "e"))
    return windows.withColumn("before", before).where("s > e or s <= before").select("clip_uid", "s", "e")


def dangling_twins(records: DataFrame) -> DataFrame:
    """Clips whose twin is not in the corpus."""
    known = records.select(F.col("clip_uid").alias("twin_uid"))
    return records.where("twin_uid is not null").join(known, "twin_uid", "left_anti").select("clip_uid", "twin_uid")
