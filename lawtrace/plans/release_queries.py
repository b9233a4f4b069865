"""Queries on clips, splits, coverage, validation and the taxonomy."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.functions import vectors as V
from lawtrace.operators import release, taxonomy, validation
from lawtrace.plans import views
from lawtrace.plans.catalog import query, r, tidy

CLIPS = views.sql_with("clips")
FAMILY_VALUES = ", ".join(f"({i}, '{f[0]}', '{f[1]}', '{f[2]}', '{f[4]}', {list(f[5])!r}, {float(f[6])!r}e0)" for i, f in enumerate(taxonomy.FAMILIES)).replace("e0e0", "e0")
SCENARIO_VALUES = ", ".join(f"('{s[0]}', '{s[1]}', {list(s[3])!r})" for s in taxonomy.SCENARIOS)
EXCEPTION_VALUES = ", ".join(f"('{f}', '{s}', '{w}')" for f, s, w in taxonomy.EXCEPTIONS)
DIMS = f"families(family_no, family, domain, law, detectable, requires, strong) as (values {FAMILY_VALUES}), scenarios(scenario, medium, provides) as (values {SCENARIO_VALUES}), exceptions(family, scenario, reason) as (values {EXCEPTION_VALUES})"
MATRIX = f"""{DIMS}, matrix as (select f.family, s.scenario, f.domain, s.medium, case when s.scenario in ('clutter_toss', 'tumble') then 'declared but not built' else e.reason end as reason
    from families f join scenarios s on list_has_all(s.provides, f.requires) left join exceptions e on e.family = f.family and e.scenario = s.scenario)"""
SIZES = """counted as (select stratum, count(*) as n from strata group by 1), z0 as (select *, round_even(0.75e0 * n, 0)::bigint a, round_even(0.2e0 * n, 0)::bigint b, round_even(0.05e0 * n, 0)::bigint c from counted),
z1 as (select stratum, n, case when a = 0 then 1 else a end as a, case when a = 0 and b >= c then b - 1 else b end as b, case when a = 0 and b < c then c - 1 else c end as c from z0),
z2 as (select stratum, n, case when b = 0 and a >= c then a - 1 else a end as a, case when b = 0 then 1 else b end as b, case when b = 0 and a < c then c - 1 else c end as c from z1),
z3 as (select stratum, n, case when c = 0 and a >= b then a - 1 else a end as a, case when c = 0 and a < b then b - 1 else b end as b, case when c = 0 then 1 else c end as c from z2),
sizes as (select stratum, n, case when n < 3 then 0 else n - b - c end as a, case when n < 3 then 0 else b end as b from z3),
ranked as (select s.*, row_number() over (partition by stratum order by sha256(pair_uid), pair_uid) as k from strata s),
splits as (select pair_uid, ranked.stratum, case when k <= a then 'main' when k <= a + b then 'held_out' else 'debug' end as split from ranked join sizes on ranked.stratum = sizes.stratum)"""


def strata(source: str) -> str:
    return f"pairs as (select distinct pair_uid from {source}), strata as (select pair_uid, case when len(string_split(pair_uid, '/')) > 2 then string_split(pair_uid, '/')[2] else '' end as stratum from pairs), {SIZES}"


@query(f"{CLIPS}, {strata('clips')} select * from splits")
def split_assignment(spark, sf_dir):
    return release.splits(views.clips(spark, sf_dir))


@query(f"with source as (select concat('rel/', r_name, '/', n_name) as pair_uid from nation join region on n_regionkey = r_regionkey), {strata('source')} select * from splits")
def split_small_strata(spark, sf_dir):
    """Five nations for each region: shares of a small stratum."""
    t = views.table(spark, sf_dir, "nation").join(views.table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    return release.splits(t.select(F.concat_ws("/", F.lit("rel"), "r_name", "n_name").alias("pair_uid")))


@query(f"with source as (select concat('rel/', r_name, '/only') as pair_uid from region), {strata('source')} select * from splits")
def split_tiny_strata(spark, sf_dir):
    """One pair for each stratum goes to the last split."""
    return release.splits(views.table(spark, sf_dir, "region").select(F.concat_ws("/", F.lit("rel"), "r_name", F.lit("only")).alias("pair_uid")))


@query(CLIPS + " select pair_uid, count(*) filter (where label = 'valid') as valid, count(*) filter (where label = 'invalid') as invalid from clips group by 1 having valid <> 1 or invalid < 1")
def pair_integrity(spark, sf_dir):
    return release.pair_integrity(views.clips(spark, sf_dir))


def with_split(spark, sf_dir):
    c = views.clips(spark, sf_dir)
    return c.join(release.splits(c), "pair_uid").withColumn("camera_motion", F.when(F.col("moving"), "orbit").otherwise("static"))


JOINED = f"{CLIPS}, {strata('clips')}, placed as (select c.*, s.split, case when moving then 'orbit' else 'static' end as camera_motion from clips c join splits s on c.pair_uid = s.pair_uid)"


@query(JOINED + " select n.split, count(p.clip_uid) as clips, count(distinct p.pair_uid) as pairs, count(distinct p.scenario) as scenarios from (values ('main'), ('held_out'), ('debug')) n(split) left join placed p on p.split = n.split group by 1")
def release_counters(spark, sf_dir):
    return release.counters(with_split(spark, sf_dir))


@query(JOINED + f" select scenario, count(*) as clips, count(*) filter (where label = 'valid') as valid, count(*) filter (where label = 'invalid') as invalid, {r('avg((camera_motion <> $$static$$)::int)', 'moving_share')} from placed group by 1")
def release_card(spark, sf_dir):
    return tidy(release.card(with_split(spark, sf_dir), "scenario"))


@query(JOINED + f", axes as (select label, camera_motion, unnest(['all', 'scenario', 'severity_bin', 'family_no']) as axis, unnest(['all', scenario, case when magnitude > 50000 then severity_bin end, family_no::varchar]) as value from placed) select axis, value, count(*) as clips, count(*) filter (where label = 'valid') as valid, count(*) filter (where label = 'invalid') as invalid, {r('avg((camera_motion <> $$static$$)::int)', 'moving_share')} from axes where value is not null group by 1, 2")
def release_card_axes(spark, sf_dir):
    """Counts of all clips and by scenario, severity and family."""
    index = with_split(spark, sf_dir).withColumn("severity_bin", F.when(F.col("magnitude") > 50000, F.col("severity_bin")))
    return tidy(release.card_by_axis(index, ("scenario", "severity_bin", "family_no")))


@query(f"with source as (select concat('rel/', c_custkey, '/only') as pair_uid from customer), {strata('source')}, i as (select s.pair_uid, split, stratum as scenario from splits s), per as (select count(distinct pair_uid) / greatest(count(distinct scenario), 1)::double as per from i) select n.split, count(i.pair_uid) as clips, count(distinct i.pair_uid) as pairs, count(distinct i.scenario) as scenarios, case when count(i.pair_uid) > 0 then 1 else 0 end as shards, case when count(i.pair_uid) = 0 then printf('empty: %.1f pairs a scenario do not fill three splits', any_value(per)) end as note from (values ('main'), ('held_out'), ('debug')) n(split) cross join per left join i on i.split = n.split group by 1")
def release_notes(spark, sf_dir):
    """One pair for each customer as a scenario: every split but the last is empty, and says why."""
    pairs = views.table(spark, sf_dir, "customer").select(F.concat_ws("/", F.lit("rel"), "c_custkey", F.lit("only")).alias("pair_uid"))
    index = release.splits(pairs).withColumnRenamed("stratum", "scenario")
    shards = index.select("split", F.lit("one").alias("shard")).distinct()
    return release.with_notes(release.counters(index, shards), index)


@query(CLIPS + ", invalid as (select * from clips where label = 'invalid') select scenario, null as severity_bin, count(*) as clips, " + r("avg(magnitude)", "mean_magnitude", 4) + " from invalid group by 1 union all select scenario, severity_bin, count(*), " + r("avg(magnitude)", "m", 4) + " from invalid group by 1, 2 union all select null, null, count(*), " + r("avg(magnitude)", "m", 4) + " from invalid")
def evaluation_breakdown(spark, sf_dir):
    return tidy(release.breakdown(views.clips(spark, sf_dir), "scenario", "severity_bin"), 4)


@query("select p_brand, count(distinct p_type) as p_type, count(distinct p_size) as p_size, count(distinct round(p_retailprice, 1)) as p_retailprice from part group by 1")
def diversity_axes(spark, sf_dir):
    return release.diversity(views.table(spark, sf_dir, "part"), "p_brand", {"p_type": None, "p_size": None, "p_retailprice": 1})


SCEN_LIST = "[" + ", ".join(f"'{s[0]}'" for s in taxonomy.SCENARIOS) + "]"
NAMES = [f[0] for f in taxonomy.FAMILIES]


def staged(spark, sf_dir):
    """Clips with the scenario and family of the taxonomy that their keys name."""
    scen = F.element_at(F.array(*[F.lit(s[0]) for s in taxonomy.SCENARIOS]), (F.col("o_orderkey") % 15 + 1).cast("int"))
    fam = taxonomy.families(spark).select(F.col("family_no").cast("long").alias("family_no"), "family", "domain")
    return views.clips(spark, sf_dir).withColumn("scenario", scen).join(F.broadcast(fam), "family_no")


STAGED = f"{CLIPS}, {MATRIX}, staged as (select c.* replace ({SCEN_LIST}[(o_orderkey % 15 + 1)::int] as scenario), f.family, f.domain from clips c join families f on f.family_no = c.family_no)"


@query(f"{STAGED}, s as (select * from staged where label = 'invalid' and severity_bin = 'strong' and magnitude > 100000) select m.scenario, " + ", ".join(f"arg_max(s.clip_uid, o_orderkey) filter (where m.family = '{f}') as {f}" for f in NAMES) + ", count(distinct s.family) as built, count(distinct m.family) as total from matrix m left join s on s.scenario = m.scenario and s.family = m.family where m.reason is null group by 1")
def coverage_lattice(spark, sf_dir):
    """The latest strong clip of every cell: scenarios by families, and how many of the planned ones are there."""
    c = staged(spark, sf_dir).where("label = 'invalid' and severity_bin = 'strong' and magnitude > 100000").select("scenario", "family", "clip_uid", "o_orderkey")
    planned = taxonomy.matrix(spark).where("cell = 'build'").select("scenario", "family")
    return release.coverage(c, "scenario", "family", "clip_uid", "o_orderkey", NAMES, planned)


@query(STAGED + f" select domain, family, severity_bin, moving, count(*) as clips, {r('sum(magnitude)', 'total_magnitude', 2)} from staged where label = 'invalid' group by rollup (domain, family, severity_bin, moving)")
def evaluation_by_family(spark, sf_dir):
    """Invalid clips by domain, family, severity and whether the camera moves; families are pooled in their domain's own row only."""
    found = release.breakdown(staged(spark, sf_dir), "domain", "family", "severity_bin", "moving")
    return tidy(found.withColumn("total_magnitude", F.col("mean_magnitude") * F.col("clips")).drop("mean_magnitude"), 2)


@query(f"{CLIPS}, {DIMS} select s.scenario, f.family from (select distinct scenario from clips) s cross join families f where not exists (select 1 from clips c where c.scenario = s.scenario and c.family_no = f.family_no and c.severity_bin = 'strong' and c.label = 'invalid')")
def missing_cells(spark, sf_dir):
    c = views.clips(spark, sf_dir)
    fam = taxonomy.families(spark).select("family_no", "family")
    done = c.where("severity_bin = 'strong' and label = 'invalid'").join(F.broadcast(fam), "family_no").select("scenario", "family").distinct()
    expected = c.select("scenario").distinct().crossJoin(F.broadcast(fam.select("family")))
    return release.missing(expected, done, ["scenario", "family"])


@query(f"{CLIPS}, {DIMS} select c.scenario, count(*) as clips_in_release, array_to_string(list_sort(list(distinct f.family)), ',') as families, count(distinct f.domain) as domains from clips c join families f on c.family_no = f.family_no where label = 'invalid' group by 1")
def release_taxonomy(spark, sf_dir):
    c = views.clips(spark, sf_dir).where("label = 'invalid'").join(F.broadcast(taxonomy.families(spark).select("family_no", "family", "domain")), "family_no")
    return c.groupBy("scenario").agg(F.count("*").alias("clips_in_release"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.countDistinct("domain").alias("domains"))


@query(STAGED + " select m.family, m.scenario, m.domain, m.medium, case when reason is null then 'build' else 'defer' end as cell, reason, count(s.clip_uid) as clips from matrix m left join staged s on s.family = m.family and s.scenario = m.scenario and s.label = 'invalid' group by all")
def taxonomy_matrix(spark, sf_dir):
    """The compatible cells and the invalid clips that each of them has."""
    n = staged(spark, sf_dir).where("label = 'invalid'").groupBy("family", "scenario").agg(F.count("*").alias("clips"))
    return taxonomy.matrix(spark).join(n, ["family", "scenario"], "left").na.fill(0, ["clips"])


@query(STAGED + """, made as (select scenario, family, (o_orderkey % 4)::int as variant, count(*) as clips from staged where label = 'invalid' and magnitude > 200000 group by 1, 2, 3), wanted as (select scenario, family, v::int as variant from matrix, range(4) t(v) where reason is null)
select w.scenario, w.variant, array_to_string(list_sort(list(w.family)), ',') as families, coalesce(array_to_string(list_sort(list(w.family) filter (where m.clips is null)), ','), '') as open, coalesce(sum(m.clips), 0)::bigint as clips, 4242 + w.variant as seed
from wanted w left join made m on m.scenario = w.scenario and m.family = w.family and m.variant = w.variant group by 1, 2""")
def taxonomy_jobs(spark, sf_dir):
    """One job for each scenario and variant, and the families that it still lacks a large clip of."""
    made = staged(spark, sf_dir).where("label = 'invalid' and magnitude > 200000").groupBy("scenario", "family", (F.col("o_orderkey") % 4).cast("int").alias("variant")).agg(F.count("*").alias("clips"))
    j = taxonomy.jobs(taxonomy.matrix(spark), made, 4, 4242)
    return j.withColumns({c: F.array_join(c, ",") for c in ("families", "open")})


@query(STAGED + f", n as (select scenario, count(*) filter (where label = 'invalid') as invalid, count(*) filter (where label = 'valid') as valid from staged group by 1) select scenario, invalid, valid, {r('(invalid + valid) * 637e0 / 3600e0 / 2.5e0', 'hours')} from n")
def release_pricing(spark, sf_dir):
    """Renders and hours of the corpus, by scenario."""
    return tidy(taxonomy.spent(staged(spark, sf_dir), "scenario", "release-solid", 4))


@query(f"{CLIPS}, {DIMS} select c.clip_uid, f.family, f.law, f.detectable, case when f.detectable = 'event' then 2 else 7 end as detect_start, {r('f.strong', 'strong')} from clips c join families f on c.family_no = f.family_no")
def family_dispatch(spark, sf_dir):
    """Law, strong residual and the windows a clip is scored on: intervention for events, consequence for states."""
    f = taxonomy.families(spark).select("family_no", "family", "law", "detectable", "strong")
    c = views.clips(spark, sf_dir).join(F.broadcast(f), "family_no").withColumn("intervention", F.array(F.struct(F.lit(2).alias("s"), F.lit(4).alias("e")))).withColumn("consequence", F.array(F.struct(F.lit(7).alias("s"), F.lit(9).alias("e"))))
    start = F.array_min(F.transform(F.when(F.col("detectable") == "event", F.col("intervention")).otherwise(F.col("consequence")), lambda w: w["s"]))
    return tidy(c.select("clip_uid", "family", "law", "detectable", start.alias("detect_start"), "strong"))


# ---- nested clip records made of orders

def records(spark, sf_dir):
    c = views.clips(spark, sf_dir).join(F.broadcast(taxonomy.families(spark).select("family_no", "family", "domain")), "family_no")
    scen = F.element_at(F.array(*[F.lit(s[0]) for s in taxonomy.SCENARIOS]), (F.col("o_orderkey") % 15 + 1).cast("int"))
    start = (F.col("o_orderkey") % 9).cast("int")
    window = F.struct(start.alias("s"), (start + 3).alias("e"))
    late = F.struct((start + 3 + F.col("o_orderkey") % 3).cast("int").alias("s"), (start + 8).alias("e"))
    violation = F.struct(
        start.alias("t_event_frame"), (start + F.col("o_orderkey") % 4 - 1).cast("int").alias("t_observable_frame"), (start + 8).alias("t_end_frame"), (F.col("o_orderkey") % 4 - 1).cast("int").alias("observability_lag_frames"), F.array(window, late).alias("violation_windows"), F.array(window).alias("intervention_windows"),
        F.array(F.lit(1), (F.col("o_orderkey") % 4).cast("int")).alias("causal_body_ids"), F.when(F.col("family") == "global_gravity", "global").otherwise("local").alias("spatial_extent"), F.struct("severity_bin", "magnitude").alias("intervention"), F.struct((F.col("magnitude") / 1e6).alias("score")).alias("peak_residual"),
    )
    body = lambda n, role, dormant: F.struct(F.lit(n).alias("body_id"), F.lit(role).alias("role"), F.lit("sphere" if n != 2 else "cube").alias("category"), F.lit("wood").alias("material"), (F.col("magnitude") / 100).alias("mass_kg"), dormant.alias("dormant"))
    return c.select(
        "clip_uid", "pair_uid", F.concat("pair_uid", F.lit("/"), (F.col("o_orderkey") - F.col("o_orderkey") % 2).cast("string")).alias("twin_uid"), "label", scen.alias("scenario"), "family", F.when(F.col("o_orderkey") % 50 == 0, "identity").otherwise(F.col("domain")).alias("domain"), F.when(scen == "pour", "granular").when(scen == "shadow_track", "optical").otherwise("rigid").alias("physics_medium"),
        (F.col("o_orderkey") % 4).cast("int").alias("seed"), F.when(F.col("o_orderkey") % 2 == 0, "v0").otherwise('{"name": "v1", "fps": 24}').alias("tier"), F.lit("L2").alias("complexity"), F.lit(16).alias("num_frames"), F.lit(12).alias("fps"), F.struct(F.when(F.col("moving"), "orbit").otherwise("static").alias("motion")).alias("camera"),
        F.array(body(1, "actor", F.col("o_orderkey") % 2 == 0), body(2, "actor", F.lit(False)), body(3, "floor", F.lit(None).cast("boolean"))).alias("instances"), F.array(F.struct(F.when(F.col("o_orderkey") % 11 != 0, "CC0").alias("license"))).alias("assets"), (F.col("o_orderkey") % 13 != 0).alias("prefix_identical"),
        (F.col("magnitude") / 10).alias("energy_total"), ((F.col("o_orderkey") % 100) / 5e3).alias("energy_anomaly"), F.when(F.col("label") == "invalid", violation).alias("violation"), F.lit("a clip").alias("prompt"), "o_orderkey",
    )


REC = f"""{CLIPS}, {MATRIX}, recs as (select c.*, f.family, f.domain as known_domain, {SCEN_LIST}[(o_orderkey % 15 + 1)::int] as scen, case when o_orderkey % 50 = 0 then 'identity' else f.domain end as domain, (o_orderkey % 9)::int as start from clips c join families f on c.family_no = f.family_no)"""


_inv = lambda e: f"case when label = 'invalid' then {e} end"
INDEX_SQL = REC + f""", {strata('clips')} select r.clip_uid, r.pair_uid, concat(r.pair_uid, '/', (o_orderkey - o_orderkey % 2)::varchar) as twin_uid, r.label, scen as scenario, r.family, r.domain, case when scen = 'pour' then 'granular' when scen = 'shadow_track' then 'optical' else 'rigid' end as medium,
{_inv('severity_bin')} as severity_bin, {r(_inv('magnitude'), 'magnitude')}, {r(_inv('magnitude / 1e6'), 'peak_severity')}, {_inv('start')} as t_event_frame, case when label = 'invalid' then concat('[{{"s":', start, ',"e":', start + 3, '}},{{"s":', start + 3 + o_orderkey % 3, ',"e":', start + 8, '}}]') else '[]' end as violation_windows,
{_inv('(o_orderkey % 4 - 1)::int')} as observability_lag, (o_orderkey % 4)::int as seed, case when o_orderkey % 2 = 0 then 'v0' else 'v1' end as tier, 'L2' as complexity, 16 as num_frames, 12 as fps, case when moving then 'orbit' else 'static' end as camera_motion, case when o_orderkey % 2 = 0 then 'cube' else 'sphere' end as actor_shape, 'wood' as actor_material,
{r('magnitude / 100', 'actor_mass')}, 'a clip' as prompt, s.split from recs r join splits s on s.pair_uid = r.pair_uid"""


@query(INDEX_SQL)
def index_rows(spark, sf_dir):
    """Nested clip records flattened to the 25 columns of the index."""
    rec = records(spark, sf_dir)
    # the pairs are read once, and distinct before anything else: records are wide
    pairs = views.clips(spark, sf_dir).select("pair_uid").distinct()
    return tidy(release.index_rows(rec, release.splits(pairs)))


#: Clips by the remainder of their key: the fault that ``faulty`` puts into each.
FAULTY = REC + """, faulty as (select *, o_orderkey % 29 as q, label = 'invalid' and o_orderkey % 29 <> 5 as violated, start + case when o_orderkey % 29 = 7 then 1 else 0 end as event, start + o_orderkey % 4 - 1 as seen from recs)"""
RULES = {
    "domain differs": "domain <> known_domain",
    "scenario unknown": "q = 2",
    "cell not in matrix": "q = 2 or not exists (select 1 from matrix m where m.family = r.family and m.scenario = r.scen)",
    "medium": "q = 3 or (q = 2 and scen = 'pour')",
    "asset without licence": "o_orderkey % 11 = 0",
    "prefix differs": "o_orderkey % 13 = 0",
    "energy not finite": "q = 4",
    "valid clip gains energy": "label = 'valid' and (o_orderkey % 100) / 5e3 > 0.01",
    "violation iff invalid": "label = 'invalid' and q = 5",
    "intervention outside": "violated and o_orderkey % 17 = 0 and o_orderkey % 3 = 2",
    "frames out of order": "violated and seen < event",
    "windows bad": "violated and (o_orderkey % 3 = 0 or start + 8 >= 16)",
    "extremes differ": "violated and event <> start",
    "extent": "violated and q = 6",
    "culprit not declared": "violated and o_orderkey % 4 = 0",
}


def faulty(spark, sf_dir):
    """Records of which one in 29 each has an unknown family, an unknown scenario, another medium, no energy, no violation,
    another extent or another first frame, and one in 17 an intervention across both windows of its violation."""
    q, v = F.col("o_orderkey") % 29, F.col("violation")
    both = F.array(F.struct((v["t_event_frame"] + 1).alias("s"), (v["t_event_frame"] + 6).alias("e")))
    changed = v.withField("intervention_windows", F.when(F.col("o_orderkey") % 17 == 0, both).otherwise(v["intervention_windows"]))
    changed = changed.withField("spatial_extent", F.when(q == 6, F.when(v["spatial_extent"] == "global", "local").otherwise("global")).otherwise(v["spatial_extent"]))
    changed = changed.withField("t_event_frame", v["t_event_frame"] + F.when(q == 7, 1).otherwise(0))
    return records(spark, sf_dir).withColumns({
        "violation": F.when(q != 5, changed), "family": F.when(q == 1, "unheard_of").otherwise(F.col("family")), "scenario": F.when(q == 2, "nowhere").otherwise(F.col("scenario")),
        "physics_medium": F.when(q == 3, "fluid").otherwise(F.col("physics_medium")), "energy_total": F.when(q == 4, float("nan")).otherwise(F.col("energy_total")),
    })


@query(FAULTY + " select clip_uid, 'family unknown' as rule from faulty where q = 1 union all " + " union all ".join(f"select clip_uid, '{n}' as rule from faulty r where q <> 1 and ({c})" for n, c in RULES.items()))
def validation_rules(spark, sf_dir):
    return validation.violations(faulty(spark, sf_dir))


@query(REC + " select clip_uid, 'asset without licence' as rule, 0 as asset from recs where o_orderkey % 11 = 0")
def validation_assets(spark, sf_dir):
    return validation.unlicensed(records(spark, sf_dir))


ENERGY_TRACE = "select l_orderkey as clip_uid, cast(l_quantity % 7 as int) as frame, l_linenumber as body_id, l_extendedprice as energy from {lineitem}"
TRACE = "select clip_uid, frame, sum(energy) * (case when clip_uid % 13 = 0 and frame > 2 then 1.01e0 else 1e0 end) as total, max(energy) / 5e6 as contact_anomaly, min(energy) / 4e6 as free_anomaly, (clip_uid % 50) * frame / 2e4 as excess_loss from {each} group by clip_uid, frame"


@query(f"""with each_body as ({ENERGY_TRACE.format(lineitem="lineitem")}), trace as ({TRACE.format(each="each_body")}), s as (select clip_uid, frame, sum(energy) as s from each_body group by 1, 2),
g as (select t.clip_uid, max(abs(s.s - case when t.clip_uid % 17 = 0 then 'nan'::double else total end)) as drift, arg_min(abs(total), t.frame) as e0, max(contact_anomaly) as contact_anomaly, max(free_anomaly) as free_anomaly, max(excess_loss) as excess_loss from trace t join s on s.clip_uid = t.clip_uid and s.frame = t.frame group by 1)
select clip_uid, 'energy not finite' as rule from g where clip_uid % 17 = 0 union all select clip_uid, 'energy by body differs' from g where clip_uid % 17 <> 0 and drift > 1e-3 * greatest(e0, 1e-9)
""" + " ".join(f"union all select clip_uid, 'valid clip: {c}' from g where clip_uid % 2 = 0 and {c} > 0.01" for c in validation.CHANNELS))
def validation_energy(spark, sf_dir):
    """Energies of order lines as bodies, with totals off in every thirteenth clip and not finite in every seventeenth."""
    each = spark.sql(ENERGY_TRACE, lineitem=views.table(spark, sf_dir, "lineitem"))
    trace = spark.sql(TRACE, each=each).withColumn("total", F.when(F.col("clip_uid") % 17 == 0, float("nan")).otherwise(F.col("total")))
    labels = each.select("clip_uid").distinct().withColumn("label", F.when(F.col("clip_uid") % 2 == 0, "valid").otherwise("invalid"))
    return validation.energy_violations(labels, trace, each)


@query(REC + " select clip_uid, start + 3 + (o_orderkey % 3)::int as s, start + 8 as e from recs where label = 'invalid' and o_orderkey % 3 = 0")
def validation_window_order(spark, sf_dir):
    w = records(spark, sf_dir).where("label = 'invalid'").select("clip_uid", F.explode("violation.violation_windows").alias("w")).select("clip_uid", "w.s", "w.e")
    return validation.disordered_windows(w)


@query(REC + " select r.clip_uid, concat(pair_uid, '/', (o_orderkey - o_orderkey % 2)::varchar) as twin_uid from recs r where not exists (select 1 from recs k where k.clip_uid = concat(r.pair_uid, '/', (r.o_orderkey - r.o_orderkey % 2)::varchar))")
def validation_twins(spark, sf_dir):
    """A twin is the even neighbour of the same customer: even clips name themselves, and of odd ones few have such a neighbour."""
    return validation.dangling_twins(records(spark, sf_dir))


@query(f"{CLIPS}, {DIMS} select distinct 'unknown scenario' as rule, c.scenario as item from clips c where not exists (select 1 from scenarios s where s.scenario = c.scenario)")
def taxonomy_consistency(spark, sf_dir):
    """Faults of the dimensions, of which there are none, and scenarios of the corpus that they do not know."""
    return taxonomy.inconsistencies(spark).unionByName(taxonomy.unknown_scenarios(views.clips(spark, sf_dir)))


@query(CLIPS + ", m as (select scenario, family_no, severity_bin, avg(abs(magnitude)) as mean_magnitude from clips group by 1, 2, 3), l as (select *, lag(mean_magnitude) over (partition by scenario, family_no order by case severity_bin when 'weak' then 0 when 'medium' then 1 else 2 end) as before from m) select scenario, family_no, severity_bin, " + r("mean_magnitude", "mean_magnitude", 4) + ", mean_magnitude >= before as rising from l")
def severity_ladder(spark, sf_dir):
    return tidy(release.ladder(views.clips(spark, sf_dir), ["scenario", "family_no"]), 4)


@query(CLIPS + " select clip_key, concat('rel/', replace(scenario, ' ', '_'), '/', printf('%04d', o_orderkey % 400)) as pair_uid, case when true then replace(scenario, ' ', '_') end as stratum from clips")
def uid_composition(spark, sf_dir):
    uid = release.pair_uid(F.lit("rel"), F.replace("scenario", F.lit(" "), F.lit("_")), F.col("o_orderkey") % 400)
    return views.clips(spark, sf_dir).select("clip_key", uid.alias("pair_uid"), release.stratum(uid).alias("stratum"))


@query(STAGED + " select clip_key, case when label = 'valid' then concat(p, '/valid') else concat(p, '/invalid_', family, '_', severity_bin) end as clip_uid, case when label = 'valid' then concat(p, '/invalid_', family, '_', severity_bin) else concat(p, '/valid') end as twin_uid from (select *, concat('rel/', scenario, '/', printf('%04d', o_orderkey % 400)) as p from staged)")
def uid_clips(spark, sf_dir):
    """Uids of clips and of the twins that they are compared with."""
    pair = release.pair_uid(F.lit("rel"), F.col("scenario"), F.col("o_orderkey") % 400)
    names = pair, F.col("label"), F.col("family"), F.col("severity_bin")
    return staged(spark, sf_dir).select("clip_key", release.clip_uid(*names).alias("clip_uid"), release.twin_uid(*names).alias("twin_uid"))


@query("select p_partkey, case when p_size > 25 then concat('Push ', p_size, ' ', p_name, 's past a ', split_part(p_name, ' ', 1), ' wall') else concat('Push ', case when lower(substring(p_name, 1, 1)) in ('a','e','i','o','u') then 'an ' else 'a ' end, p_name, ' past a ', split_part(p_name, ' ', 1), ' wall') end as prompt from part")
def prompts(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").withColumn("colour", F.substring_index("p_name", " ", 1)).withColumn("noun", F.expr("substring(p_name, length(colour) + 2)"))
    return p.select("p_partkey", release.caption(F.lit("Push {subject} past a {colour} wall"), F.col("colour"), F.col("noun"), F.when(F.col("p_size") > 25, F.col("p_size")).otherwise(1)).alias("prompt"))


@query("select l_orderkey, min(l_linenumber) as t_event, max(l_linenumber + l_quantity::int) as t_end, count(*) as windows from lineitem group by 1")
def plan_records(spark, sf_dir):
    """Event and end of a plan from its list of windows."""
    w = views.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("s"), (F.col("l_linenumber") + F.col("l_quantity").cast("int")).alias("e"))).alias("w"))
    return w.select("l_orderkey", F.array_min(F.transform("w", lambda x: x["s"])).alias("t_event"), F.array_max(F.transform("w", lambda x: x["e"])).alias("t_end"), F.size("w").cast("long").alias("windows"))


@query("""with o as (select o_custkey, o_orderkey, o_orderpriority, case when o_orderkey % 11 <> 0 then o_orderstatus else '' end as license from orders), l as (select o_custkey, license, count(*) as n from o group by 1, 2)
select o.o_custkey, count(*) as bodies, '0=background;' || string_agg(concat(o_orderkey + 1, '=', o_orderpriority), ';' order by o_orderkey) as labels, any_value(t.licences) as licences from o join (select o_custkey, string_agg(license || '=' || n, ';' order by license) as licences from l group by 1) t on t.o_custkey = o.o_custkey group by 1""")
def label_tables(spark, sf_dir):
    """Names of the ids of each group, background first, and its licences."""
    o = views.table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") + 1).cast("long").alias("body_id"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("license"))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string"))), ";")
    return release.label_table(o, "o_custkey").select("o_custkey", "bodies", text("names").alias("labels"), text("licences").alias("licences"))


# ---- colours of vectors

_c = [f"least(greatest(embedding[{i}]::double, 0), 1)" for i in (1, 2, 3)]


def _linear(x):
    return f"(case when {x} <= 0.04045e0 then {x} / 12.92e0 else power(({x} + 0.055e0) / 1.055e0, 2.4e0) end)"


_xyz = [f"(({m[0]}e0 * {_linear(_c[0])} + {m[1]}e0 * {_linear(_c[1])} + {m[2]}e0 * {_linear(_c[2])}) / {w}e0)" for m, w in zip(V.SRGB_TO_XYZ, V.WHITE)]
_f = [f"(case when {x} > 0.008856e0 then cbrt({x}) else 7.787e0 * {x} + 16e0 / 116e0 end)" for x in _xyz]


@query(f"select vec_id, {r(f'116 * {_f[1]} - 16', 'l', 3)}, {r(f'500 * ({_f[0]} - {_f[1]})', 'a', 3)}, {r(f'200 * ({_f[1]} - {_f[2]})', 'b', 3)} from embeddings")
def colour_lab(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings").selectExpr("vec_id", *[f"cast(embedding[{i}] as double) as c{c}" for i, c in enumerate("rgb")])
    return tidy(e.select("vec_id", *[x.alias(n) for x, n in zip(V.lab(V.vec("c", "rgb")), "lab")]), 3)


_max, _min = f"greatest({', '.join(_c)})", f"least({', '.join(_c)})"
_hue = f"(case when {_max} = {_min} then 0 when {_max} = {_c[0]} then ({_c[1]} - {_c[2]}) / ({_max} - {_min}) when {_max} = {_c[1]} then 2 + ({_c[2]} - {_c[0]}) / ({_max} - {_min}) else 4 + ({_c[0]} - {_c[1]}) / ({_max} - {_min}) end / 6)"


@query(f"with h as (select vec_id, {_hue} as h0 from embeddings), t as (select vec_id, h0 - floor(h0) as h from h) select vec_id, {r('h', 'hue')}, {list(V.COLOURS)!r}[(round_even(h * 8, 0)::int % 8) + 1] as name, {r('0.88e0 - 0.88e0 * 0.62e0 * greatest(0, least((5 + h * 6) - 6 * floor((5 + h * 6) / 6), 4 - ((5 + h * 6) - 6 * floor((5 + h * 6) / 6)), 1))', 'red')} from t")
def colour_names(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings").selectExpr("vec_id", *[f"least(greatest(cast(embedding[{i}] as double), 0e0), 1e0) as c{c}" for i, c in enumerate("rgb")])
    h = V.hue(V.vec("c", "rgb"))
    return tidy(e.select("vec_id", h.alias("hue"), V.colour_name(V.vec("c", "rgb")).alias("name"), V.from_hue(h, 0.62, 0.88)[0].alias("red")))
