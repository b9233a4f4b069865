"""The families, scenarios and their compatibility, as small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: FIXED VALUES: family, domain, law, kind, scored on, required capabilities, strong residual.
FAMILIES = (
    ("permanence", "identity", "mass_continuity", "sustained", "event", ("actor",), 1.0),
    ("dissolve", "identity", "mass_dissolution", "sustained", "event", ("actor",), 1.0),
    ("immutability", "identity", "shape_continuity", "sustained", "event", ("actor",), 2.3**3 - 1),
    ("fission", "identity", "object_count", "sustained", "event", ("actor", "understudy"), 1.0),
    ("fusion", "identity", "object_count", "sustained", "event", ("converging",), 0.5),
    ("continuity", "kinematics", "position_continuity", "instant", "event", ("actor",), 9.0),
    ("non_parabolic", "kinematics", "trajectory_shape", "sustained", "state", ("flight",), 1.5 * 0.9),
    ("antigravity", "kinematics", "free_fall", "sustained", "state", ("flight",), 3.8),
    ("time_slip", "kinematics", "phase_consistency", "sustained", "event", ("sliding",), 2.0),
    ("newton1_inertia", "kinematics", "linear_momentum", "sustained", "event", ("sliding",), 3.0),
    ("solidity", "contact", "penetration", "sustained", "state", ("contact",), 1.0),
    ("superelastic", "contact", "energy_at_contact", "repeated", "event", ("impact",), 1.0),
    ("phantom_impulse", "dynamics", "linear_momentum", "instant", "event", ("actor",), 7.0 / (9.81 / 12)),
    ("newton2_mass", "dynamics", "linear_momentum", "instant", "event", ("identical_pair",), 3.0),
    ("angular_momentum", "dynamics", "angular_momentum", "instant", "event", ("spin",), 3.8),
    ("support", "equilibrium", "support", "sustained", "state", ("contact",), 3.6),
    ("friction", "equilibrium", "friction", "sustained", "state", ("sliding",), 2.0),
    ("shadow", "optical", "shadow_consistency", "sustained", "state", ("cast_shadow",), 5.5),
    ("shadow_inverted", "optical", "shadow_consistency", "sustained", "state", ("cast_shadow",), 2.0),
    ("shadow_shape", "optical", "shape_anisotropy", "sustained", "state", ("cast_shadow",), 2.8**1.5 - 1),
    ("colour_shift", "appearance", "colour_continuity", "sustained", "event", ("actor",), 1.30),
    ("deformation", "appearance", "shape_anisotropy", "sustained", "event", ("actor",), 2.8**1.5 - 1),
    ("global_gravity", "global", "free_fall", "sustained", "state", ("multi_body",), 2.2),
)
#: FIXED VALUES: scenario, medium, occluder, provided capabilities.
SCENARIOS = (
    ("drop", "rigid", False, ("actor", "flight", "contact", "impact", "spin", "understudy")),
    ("collision", "rigid", False, ("actor", "contact", "impact", "identical_pair", "multi_body", "converging", "sliding", "understudy")),
    ("ramp_slide", "rigid", False, ("actor", "contact", "sliding", "understudy")),
    ("toss", "rigid", False, ("actor", "flight", "spin", "understudy")),
    ("tumble", "rigid", False, ("actor", "flight", "spin", "understudy")),
    ("occluder_pass", "rigid", True, ("actor", "contact", "sliding", "understudy")),
    ("barrier_pass", "rigid", False, ("actor", "contact", "impact", "sliding", "understudy")),
    ("stack_topple", "rigid", False, ("actor", "contact", "resting", "multi_body", "impact", "flight")),
    ("pyramid_impact", "rigid", False, ("actor", "flight", "contact", "impact", "multi_body", "resting")),
    ("pendulum_swing", "rigid", False, ("actor", "spin", "multi_body")),
    ("resting_table", "rigid", False, ("actor", "contact", "resting", "multi_body", "understudy")),
    ("rolling_ramp", "rigid", False, ("actor", "contact", "sliding", "flight", "spin", "understudy")),
    ("shadow_track", "optical", False, ("actor", "cast_shadow")),
    ("clutter_toss", "rigid", True, ("actor", "flight", "contact", "impact", "multi_body")),
    ("pour", "granular", False, ("actor", "flight", "contact", "impact", "multi_body", "converging", "identical_pair", "resting", "sliding")),
)
#: FIXED VALUES: cells that are declared but not staged, and why; then scenarios that are not built.
EXCEPTIONS = (
    ("global_gravity", "pendulum_swing", "only one body falls"),
    ("newton2_mass", "pyramid_impact", "equal bodies never strike each other"),
    ("solidity", "occluder_pass", "sinking behind a screen looks like vanishing"),
    ("time_slip", "collision", "the actor stops before the clip ends"),
    ("time_slip", "ramp_slide", "the actor stops before the clip ends"),
    ("time_slip", "pour", "a stalled grain would be passed through"),
    ("fission", "pour", "one more grain does not show"),
    ("fusion", "clutter_toss", "not built"),
    ("fission", "ramp_slide", "the halves have no level support"),
)
UNBUILT = ("clutter_toss", "tumble")
#: FIXED VALUES: laws that only their owners may move, and the rise from which a move counts: of another family, and of an owner.
EXCLUSIVE = {
    "penetration": ("solidity",), "position_continuity": ("continuity",), "mass_continuity": ("permanence",), "object_count": ("fission", "fusion", "permanence", "dissolve"),
    "shape_continuity": ("immutability", "fusion"), "shape_anisotropy": ("deformation", "shadow_shape"), "colour_continuity": ("colour_shift",), "mass_dissolution": ("dissolve",),
}
LEAK, MOVES = 1.0, 0.1
CAPABILITIES = ("actor", "flight", "contact", "impact", "identical_pair", "multi_body", "converging", "resting", "sliding", "spin", "understudy", "cast_shadow")
DOMAINS = ("identity", "kinematics", "contact", "dynamics", "equilibrium", "optical", "appearance", "global")


def families(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *f[:5], list(f[5]), f[6]) for i, f in enumerate(FAMILIES)], "family_no int, family string, domain string, law string, kind string, detectable string, requires array<string>, strong double")


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *s[:3], list(s[3])) for i, s in enumerate(SCENARIOS)], "scenario_no int, scenario string, medium string, has_occluder boolean, provides array<string>")


def exceptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EXCEPTIONS), "family string, scenario string, reason string")


def cells() -> list[tuple[str, str]]:
    """(family, scenario) of every cell whose requirements the scenario meets."""
    return [(f[0], s[0]) for f in FAMILIES for s in SCENARIOS if set(f[5]) <= set(s[3])]


def matrix(spark: SparkSession) -> DataFrame:
    """``(family, scenario, cell, reason)`` of every cell whose requirements the scenario meets: relational division.

    ``defer`` with a reason for exceptions and unbuilt scenarios, whose reason comes first, else ``build``. The product
    is of two fixed dimensions, 23 by 15.
    """
    fits = F.size(F.array_except("requires", "provides")) == 0
    cells = families(spark).join(scenarios(spark), fits).join(exceptions(spark), ["family", "scenario"], "left")
    reason = F.when(F.col("scenario").isin(*UNBUILT), "declared but not built").otherwise(F.col("reason"))
    return cells.select("family", "scenario", "domain", "medium", F.when(reason.isNull(), "build").otherwise("defer").alias("cell"), reason.alias("reason"))


def jobs(cells: DataFrame, made: DataFrame, variants: int, base_seed: int) -> DataFrame:
    """One job for each (variant, scenario) with its families, and those of them that no clip of ``made`` (scenario, family, variant, clips) shows yet; the
    seed is the base plus the variant."""
    wanted = cells.where("cell = 'build'").select("scenario", "family").withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    t = wanted.join(made, ["scenario", "family", "variant"], "left").groupBy("scenario", "variant")
    lists = F.array_sort(F.collect_list("family")).alias("families"), F.array_sort(F.collect_list(F.when(F.col("clips").isNull(), F.col("family")))).alias("open")
    return t.agg(*lists, F.coalesce(F.sum("clips"), F.lit(0)).alias("clips")).withColumn("seed", base_seed + F.col("variant"))


#: FIXED VALUES: seconds a clip at each tier, and the speed-up of worker counts; others take the defaults.
RATES = {"debug-solid": 8.0, "debug-hdri": 44.0, "release-solid": 637.0, "release-hdri": 2930.0}
SPEEDUP = {1: 1.0, 2: 1.6, 4: 2.50, 8: 2.67}


def _hours(renders: DataFrame, tier: str, workers: int) -> DataFrame:
    rate, speed = RATES.get(tier, 60.0), SPEEDUP.get(workers, max(SPEEDUP.values()))
    return renders.withColumn("hours", (F.col("invalid") + F.col("valid")) * rate / 3600.0 / speed)


def priced(cells: DataFrame, bins: int, variants: int, tier: str, workers: int) -> DataFrame:
    """Invalid and valid renders of a plan and the hours they take."""
    built = cells.where("cell = 'build'").agg(F.count("*").alias("cells"), F.countDistinct("scenario").alias("scenarios"))
    return _hours(built.select((F.col("cells") * bins * variants).alias("invalid"), (F.col("scenarios") * variants).alias("valid")), tier, workers)


def spent(clips: DataFrame, by: str, tier: str, workers: int) -> DataFrame:
    """The same of a corpus (label and the column ``by``), from the clips that it has."""
    return _hours(clips.groupBy(by).agg(F.count_if(F.col("label") == "invalid").alias("invalid"), F.count_if(F.col("label") == "valid").alias("valid")), tier, workers)


def unknown_scenarios(clips: DataFrame) -> DataFrame:
    """``(rule, item)`` of the scenarios that a corpus names and the taxonomy does not."""
    named = clips.select(F.col("scenario").alias("item")).distinct()
    known = scenarios(clips.sparkSession).select(F.col("scenario").alias("item"))
    return named.join(F.broadcast(known), "item", "left_anti").select(F.lit("unknown scenario").alias("rule"), "item")


def inconsistencies(spark: SparkSession) -> DataFrame:
    """``(rule, item)`` of dimension rows that name what does not exist: empty if the taxonomy is consistent."""
    names = lambda values: spark.createDataFrame([(v,) for v in values], "item string")
    used = {
        "unknown domain": (families(spark).select(F.col("domain").alias("item")), DOMAINS),
        "unknown requirement": (families(spark).select(F.explode("requires").alias("item")), CAPABILITIES),
        "unknown provision": (scenarios(spark).select(F.explode("provides").alias("item")), CAPABILITIES),
        "unknown kind": (families(spark).select(F.col("kind").alias("item")), ("instant", "sustained", "repeated")),
        "unknown medium": (scenarios(spark).select(F.col("medium").alias("item")), ("rigid", "optical", "granular")),
        "exception without family": (exceptions(spark).select(F.col("family").alias("item")), [f[0] for f in FAMILIES]),
        "exception without scenario": (exceptions(spark).select(F.col("scenario").alias("item")), [s[0] for s in SCENARIOS]),
    }
    out = None
    for rule, (items, known) in used.items():
        bad = items.distinct().join(names(known), "item", "left_anti").select(F.lit(rule).alias("rule"), "item")
        out = bad if out is None else out.unionByName(bad)
    return out
