"""Reading clip records and plans of a release tree, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = "array<struct<s:int,e:int>>"
RECORD = f"""clip_uid string, pair_uid string, twin_uid string, label string, scenario string, family string, domain string, physics_medium string, seed int, tier string, complexity string,
num_frames int, fps int, camera struct<motion:string>, instances array<struct<body_id:int,role:string,category:string,material:string,mass_kg:double,dormant:boolean>>, assets array<struct<license:string>>, prompt string,
prefix_identical boolean, energy_total double, energy_anomaly double,
violation struct<t_event_frame:int,t_observable_frame:int,t_end_frame:int,observability_lag_frames:int,violation_windows:{WINDOW},intervention_windows:{WINDOW},causal_body_ids:array<int>,spatial_extent:string,intervention:struct<severity_bin:string,magnitude:double>,peak_residual:struct<score:double>>"""
PLAN = "clip_uid string, pair_uid string, family string, kind string, t_event int, violation_windows array<array<int>>, causal_body_ids array<int>, magnitude double, severity_bin string, notes map<string,string>"

VECTOR = "array<double>"
SCENE = f"""scenario string, seed int, variant int, gravity {VECTOR}, floor_level double, camera struct<motion:string,position:{VECTOR},look_at:{VECTOR},end_position:{VECTOR}>, occluded_frames array<int>,
bodies array<struct<segmentation_id:int,name:string,kind:string,role:string,material:string,static:boolean,dormant:boolean,mass:double,friction:double,restitution:double,position:{VECTOR},scale:{VECTOR},quaternion:{VECTOR},color:{VECTOR}>>"""


def tree(spark: SparkSession, root: str, schema: str, name: str) -> DataFrame:
    """Every JSON file called ``name`` below ``root``, one record each, with its folder and path. Malformed files fail
    the read; an empty tree gives no rows."""
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("recursiveFileLookup", True).option("pathGlobFilter", name)
    return read.json(root).withColumn("path", F.col("_metadata.file_path")).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))


def clip_records(spark: SparkSession, root: str) -> DataFrame:
    return tree(spark, root, RECORD, "meta.json")


def plans(spark: SparkSession, root: str) -> DataFrame:
    """Plans with their windows as (s, e)."""
    t = tree(spark, root, PLAN, "plan.json")
    return t.withColumn("violation_windows", F.transform("violation_windows", lambda w: F.struct(w[0].alias("s"), w[1].alias("e"))))


#: Fields that every record must have, and those that a record with a violation must have.
REQUIRED = ("clip_uid", "pair_uid", "label", "scenario", "family", "domain", "physics_medium", "seed", "num_frames", "fps", "prefix_identical")
REQUIRED_OF_VIOLATIONS = ("t_event_frame", "t_observable_frame", "t_end_frame", "violation_windows", "causal_body_ids", "spatial_extent")


def conformance(spark: SparkSession, root: str, schema: str = RECORD, name: str = "meta.json", required: tuple[str, ...] = REQUIRED, of_violations: tuple[str, ...] = REQUIRED_OF_VIOLATIONS) -> DataFrame:
    """``(path, rule, field)`` of files that do not conform: text that is no record of the schema, by a parse that keeps what it cannot read, and fields
    that are missing or null. Fields that the schema does not name are allowed. A file that cannot be read is reported for that alone."""
    read = spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", name)
    t = read.json(root).withColumn("path", F.col("_metadata.file_path"))
    lacking = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    if "violation" in t.columns:
        lacking += [F.when(F.col("violation").isNotNull() & F.col(f"violation.{c}").isNull(), F.lit(f"violation.{c}")) for c in of_violations]
    row = lambda rule, field: F.struct(F.lit(rule).alias("rule"), field.alias("field"))
    missing = F.transform(F.array_compact(F.array(*lacking)), lambda f: row("field missing", f))
    found = F.when(F.col("_corrupt").isNotNull(), F.array(row("not of the schema", F.lit(None).cast("string")))).otherwise(missing)
    return t.select("path", F.explode(found).alias("r")).select("path", "r.*")


def scenes(spark: SparkSession, root: str, name: str = "scene.json") -> DataFrame:
    """Scenes with their bodies: (clip folder, scenario, seed, variant, gravity, floor_level, camera, bodies), one record for each file."""
    return tree(spark, root, SCENE, name)
