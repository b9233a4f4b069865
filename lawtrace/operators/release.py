"""Release operators: splits without leakage, index rows, coverage and statistics of the clips of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: FIXED VALUES: splits and their shares of the pairs, largest first.
SPLITS = (("main", 0.75), ("held_out", 0.20), ("debug", 0.05))


def pair_uid(release: Column, scenario: Column, seed: Column) -> Column:
    return F.format_string("%s/%s/%04d", release, scenario, seed)


def clip_uid(pair: Column, label: Column, family: Column, severity: Column) -> Column:
    """A clip of a pair: its lawful one, or the one of a family at a severity."""
    return F.when(label == "valid", F.concat(pair, F.lit("/valid"))).otherwise(F.concat(pair, F.lit("/invalid_"), family, F.lit("_"), severity))


def twin_uid(pair: Column, label: Column, family: Column, severity: Column) -> Column:
    """The clip that it is compared with: the lawful one, or for that the one of the family at the severity."""
    other = F.when(label == "valid", "invalid").otherwise("valid")
    return clip_uid(pair, other, family, severity)


def stratum(uid: Column) -> Column:
    """The second part of a uid of more than two parts, else empty."""
    parts = F.split(uid, "/", -1)
    return F.when(F.size(parts) > 2, parts[1]).otherwise("")


def hash_order(uid: Column) -> Column:
    """Text that sorts like the first eight bytes of the uid's SHA-256."""
    return F.substring(F.sha2(uid, 256), 1, 16)


def split_sizes(counts: DataFrame) -> DataFrame:
    """``(stratum, n)`` with the sizes of the splits.

    Fewer than three pairs all go to the last split. Otherwise shares are rounded half to even, an empty split borrows
    one from the first largest, and the first takes the remainder.
    """
    t = counts
    names = [f"n{i}" for i in range(len(SPLITS))]
    for name, (_, share) in zip(names, SPLITS):
        t = t.withColumn(name, F.bround(share * F.col("n")).cast("long"))
    for i, name in enumerate(names):
        largest = F.greatest(*names)
        first = F.lit(len(names) - 1)
        for j in range(len(names) - 2, -1, -1):
            first = F.when(F.col(names[j]) == largest, j).otherwise(first)
        t = t.withColumns({"empty": F.col(name) == 0, "donor": first})
        t = t.withColumns({x: F.when(F.col("empty") & (F.lit(j) == i), 1).when(F.col("empty") & (F.col("donor") == j), F.col(x) - 1).otherwise(F.col(x)) for j, x in enumerate(names)})
    t = t.withColumn(names[0], F.col(names[0]) + F.col("n") - sum((F.col(x) for x in names[1:]), F.col(names[0])))
    few = F.col("n") < len(SPLITS)
    return t.select("stratum", "n", *[F.when(few, F.when(F.lit(i == len(names) - 1), F.col("n")).otherwise(0)).otherwise(F.col(x)).alias(x) for i, x in enumerate(names)])


def splits(pairs: DataFrame, uid: str = "pair_uid") -> DataFrame:
    """``(pair_uid, stratum, split)`` of distinct pairs, in exact shares of each stratum, in hash order.

    A pair's rank is the pairs in earlier hash buckets, from one count for each bucket, plus its rank inside its own, so
    no task sorts a whole stratum.
    """
    p = pairs.select(F.col(uid).alias("pair_uid")).distinct().withColumn("stratum", stratum(F.col("pair_uid"))).withColumn("h", hash_order(F.col("pair_uid")))
    p = p.withColumn("bucket", F.substring("h", 1, 3))
    held = p.groupBy("stratum", "bucket").agg(F.count("*").alias("m"))
    before = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("stratum", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("earlier"))
    sizes = split_sizes(held.groupBy("stratum").agg(F.sum("m").alias("n")))
    rank = F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy("h", "pair_uid")) + F.col("earlier")
    t = p.join(offsets, ["stratum", "bucket"]).join(sizes, "stratum").withColumn("rank", rank)
    named = F.lit(SPLITS[-1][0])
    for i in range(len(SPLITS) - 2, -1, -1):
        named = F.when(F.col("rank") <= sum((F.col(f"n{j}") for j in range(1, i + 1)), F.col("n0")), SPLITS[i][0]).otherwise(named)
    return t.select("pair_uid", "stratum", named.alias("split"))


def name_of(column: Column) -> Column:
    """The name inside a JSON object, or the string itself."""
    return F.coalesce(F.get_json_object(column, "$.name"), column)


def label_table(groups: DataFrame, key: str) -> DataFrame:
    """Per key the names of its segmentation ids and the licences of its assets.

    groups: (key, body_id, name, license). ``names`` maps ids to names in id order, 0 being the background; ``licences`` maps each licence to its number of
    bodies; ``bodies`` counts them without the background."""
    t = groups.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("body_id", "name"))).alias("held"), F.count("*").alias("bodies"), F.collect_list(F.coalesce("license", F.lit(""))).alias("all_licences"))
    names = F.map_from_entries(F.concat(F.array(F.struct(F.lit(0).cast("long").alias("body_id"), F.lit("background").alias("name"))), "held"))
    kinds = F.array_sort(F.array_distinct("all_licences"))
    licences = F.map_from_entries(F.transform(kinds, lambda k: F.struct(k, F.size(F.filter("all_licences", lambda x: x == k)))))
    return t.select(key, names.alias("names"), licences.alias("licences"), "bodies")


def first_actor(instances: Column) -> Column:
    """The first instance with the role of an actor that is not dormant."""
    return F.get(F.filter(instances, lambda b: (b["role"] == "actor") & ~F.coalesce(b["dormant"], F.lit(False))), F.lit(0))


def index_rows(records: DataFrame, assigned: DataFrame) -> DataFrame:
    """One flat row of 25 columns for each nested clip record; a pair without a split counts as ``train``."""
    actor = first_actor(F.col("instances"))
    v = "violation."
    flat = records.select(
        "clip_uid", "pair_uid", "twin_uid", "label", "scenario", "family", "domain", F.col("physics_medium").alias("medium"), F.col(f"{v}intervention.severity_bin").alias("severity_bin"), F.col(f"{v}intervention.magnitude").alias("magnitude"),
        F.col(f"{v}peak_residual.score").alias("peak_severity"), F.col(f"{v}t_event_frame").alias("t_event_frame"), F.coalesce(F.to_json(f"{v}violation_windows"), F.lit("[]")).alias("violation_windows"), F.col(f"{v}observability_lag_frames").alias("observability_lag"),
        "seed", name_of(F.col("tier")).alias("tier"), name_of(F.col("complexity")).alias("complexity"), "num_frames", "fps", F.col("camera.motion").alias("camera_motion"), actor["category"].alias("actor_shape"), actor["material"].alias("actor_material"), actor["mass_kg"].alias("actor_mass"), "prompt",
    )
    return flat.join(assigned.select("pair_uid", "split"), "pair_uid", "left").withColumn("split", F.coalesce("split", F.lit("train"))).select(*flat.columns, "split")


def pair_integrity(clips: DataFrame) -> DataFrame:
    """Pairs that do not hold exactly one valid and at least one invalid clip."""
    n = clips.groupBy("pair_uid").agg(F.count_if(F.col("label") == "valid").alias("valid"), F.count_if(F.col("label") == "invalid").alias("invalid"))
    return n.where("valid <> 1 or invalid < 1")


def counters(index: DataFrame, shards: DataFrame | None = None) -> DataFrame:
    """Clips, pairs and scenarios of every split, empty splits included; with ``shards`` (split, shard) their number too."""
    n = index.groupBy("split").agg(F.count("*").alias("clips"), F.countDistinct("pair_uid").alias("pairs"), F.countDistinct("scenario").alias("scenarios"))
    names = index.sparkSession.createDataFrame([(s,) for s, _ in SPLITS], "split string")
    out = names.join(n, "split", "left")
    if shards is not None:
        out = out.join(shards.groupBy("split").agg(F.countDistinct("shard").alias("shards")), "split", "left")
    return out.na.fill(0)


def with_notes(counted: DataFrame, index: DataFrame) -> DataFrame:
    """``counters`` with ``note`` on empty splits: how many pairs a scenario has, as shares are taken within scenarios and two pairs fill no three splits."""
    per = index.agg((F.countDistinct("pair_uid") / F.greatest(F.countDistinct("scenario"), F.lit(1))).alias("per"))  # one row
    t = counted.withColumn("one", F.lit(1)).join(F.broadcast(per.withColumn("one", F.lit(1))), "one").drop("one")
    text = F.format_string("empty: %.1f pairs a scenario do not fill three splits", F.col("per"))
    return t.withColumn("note", F.when(F.col("clips") == 0, text)).drop("per")


def card_by_axis(index: DataFrame, axes: tuple[str, ...] = ("scenario", "family", "tier")) -> DataFrame:
    """``(axis, value, clips, valid, invalid, moving_share)``: the counts of ``card`` for all clips (axis "all") and by each axis, from one pass; nulls are no value."""
    values = F.array(F.struct(F.lit("all").alias("axis"), F.lit("all").alias("value")), *[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes])
    each = index.select("label", "camera_motion", F.explode(values).alias("v")).select("label", "camera_motion", "v.*").where("value is not null")
    moving = F.avg((F.coalesce("camera_motion", F.lit("static")) != "static").cast("double"))
    return each.groupBy("axis", "value").agg(F.count("*").alias("clips"), F.count_if(F.col("label") == "valid").alias("valid"), F.count_if(F.col("label") == "invalid").alias("invalid"), moving.alias("moving_share"))


def card(index: DataFrame, by: str) -> DataFrame:
    """Counts by a column: all, valid, invalid, and the share with a moving camera."""
    moving = F.avg((F.col("camera_motion") != "static").cast("double"))
    return index.groupBy(by).agg(F.count("*").alias("clips"), F.count_if(F.col("label") == "valid").alias("valid"), F.count_if(F.col("label") == "invalid").alias("invalid"), moving.alias("moving_share"))


def diversity(rows: DataFrame, group: str, axes: dict[str, int | None]) -> DataFrame:
    """Distinct values of every axis in each group; numbers count after rounding to the given digits."""
    return rows.groupBy(group).agg(*[F.countDistinct(F.col(c) if d is None else F.round(c, d)).alias(c) for c, d in axes.items()])


def coverage(cells: DataFrame, rows: str, columns: str, value: str, order: str, names: list[str], planned: DataFrame | None = None) -> DataFrame:
    """A row for each ``rows`` and a column for each name: the latest clip's value, null where missing, and how many are ``built``.

    With ``planned``, distinct (rows, columns), every planned row is there, with the ``total`` of its planned cells, and only planned cells count."""
    if planned is not None:
        cells = planned.join(cells, [rows, columns], "left")
    wide = cells.groupBy(rows).pivot(columns, names).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))))
    wide = wide.withColumn("built", sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0)))
    return wide if planned is None else wide.join(planned.groupBy(rows).agg(F.count("*").alias("total")), rows)


def breakdown(rows: DataFrame, *by: str) -> DataFrame:
    """Rollup of the invalid clips."""
    return rows.where("label = 'invalid'").rollup(*by).agg(F.count("*").alias("clips"), F.avg("magnitude").alias("mean_magnitude"))


def missing(expected: DataFrame, produced: DataFrame, key: list[str]) -> DataFrame:
    """Expected cells that were not produced."""
    return expected.join(produced, key, "left_anti")


def caption(template: Column, colour: Column, noun: Column, count: Column) -> Column:
    """A template with its colour, noun and article or number filled in."""
    thing = F.concat_ws(" ", colour, noun)
    article = F.when(F.lower(F.substring(thing, 1, 1)).isin(*"aeiou"), "an").otherwise("a")
    return F.replace(F.replace(template, F.lit("{subject}"), F.when(count > 1, F.concat_ws(" ", count.cast("string"), F.concat(thing, F.lit("s")))).otherwise(F.concat_ws(" ", article, thing))), F.lit("{colour}"), colour)


def ladder(clips: DataFrame, scene: list[str]) -> DataFrame:
    """Mean absolute magnitude of each severity of a scene, and whether it is at least that of the next weaker one."""
    order = F.when(F.col("severity_bin") == "weak", 0).when(F.col("severity_bin") == "medium", 1).otherwise(2)
    mean = clips.groupBy(*scene, "severity_bin").agg(F.avg(F.abs("magnitude")).alias("mean_magnitude"))
    before = F.lag("mean_magnitude").over(Window.partitionBy(*scene).orderBy(order))
    return mean.withColumn("rising", F.col("mean_magnitude") >= before)
