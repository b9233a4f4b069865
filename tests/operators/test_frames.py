"""Intervals, severity and grids on hand-made clips."""

import random

import pytest
from pyspark.sql import functions as F

from lawtrace.operators import edits, geometry, intervals, materials, pixels, severity, twins

KEY = ["clip_uid"]


def clip(spark, **columns):
    n = len(next(iter(columns.values())))
    rows = [(1, i, *(c[i] for c in columns.values())) for i in range(n)]
    kinds = {bool: "boolean", float: "double", int: "int"}
    return spark.createDataFrame(rows, "clip_uid int, frame int, " + ", ".join(f"{k} {kinds[type(v[0])]}" for k, v in columns.items()))


def flags(n, *windows):
    return [any(s <= i <= e for s, e in windows) for i in range(n)]


@pytest.mark.parametrize("n, windows", [(13, [(1, 2), (5, 7)]), (20, [(3, 4), (8, 9), (13, 14)]), (10, [(0, 9)]), (5, [])])
def test_windows_round_trip(spark, n, windows):
    rows = clip(spark, on=flags(n, *windows))
    found = intervals.islands(rows, KEY, "on")
    assert sorted((r.s, r.e) for r in found.collect()) == windows
    back = intervals.rasterised(rows, found, KEY).orderBy("frame").collect()
    assert [r.active for r in back] == flags(n, *windows)


def loop(score, active, observable):
    n, out, t = len(score), {}, 0
    while t < n:
        if not active[t]:
            t += 1
            continue
        end = max(i for i in range(t, n) if all(active[t : i + 1]))
        held, seen = 0.0, False
        for f in range(t, end + 1):
            held = max(held, score[f])
            if observable[f]:
                out[f], held, seen = held, 0.0, True
        if not seen:
            for f in range(end + 1, n):
                if active[f]:
                    break
                if observable[f]:
                    out[f] = held
                    break
        t = end + 1
    return out


@pytest.mark.parametrize(
    "score, active, observable, want",
    [
        ([0.0, 0.0, 0.9, 0.1, 0.2, 0.3, 0.0, 0.0], (2, 5), (3, 7), {3: 0.9, 4: 0.2, 5: 0.3}),
        ([0.1, 0.2, 0.3, 0.4, 0.5, 0.6], (1, 4), (0, 5), {1: 0.2, 2: 0.3, 3: 0.4, 4: 0.5}),
        ([0.0, 0.0, 0.0, 0.0, 0.5, 0.8, 0.0, 0.0], (4, 5), (6, 7), {6: 0.8}),
        ([0.0, 0.5, 0.5, 0.0], (1, 2), (9, 9), {}),
    ],
)
def test_severity_goes_to_the_evidence(spark, score, active, observable, want):
    n = len(score)
    rows = clip(spark, score=score, active=flags(n, active), observable=flags(n, observable))
    assert {r.frame: r.placed for r in intervals.attributed(rows, KEY).where("gate").collect()} == want


def test_severity_like_the_loop(spark):
    rng, rows, want = random.Random(1), [], {}
    for c in range(300):
        n = rng.randint(1, 14)
        s, a, o = [rng.randint(0, 9) / 10 for _ in range(n)], [rng.random() < 0.5 for _ in range(n)], [rng.random() < 0.4 for _ in range(n)]
        rows += [(c, i, s[i], a[i], o[i]) for i in range(n)]
        want |= {(c, f): v for f, v in loop(s, a, o).items()}
    t = spark.createDataFrame(rows, "clip_uid int, frame int, score double, active boolean, observable boolean")
    assert {(r.clip_uid, r.frame): r.placed for r in intervals.attributed(t, KEY).where("gate").collect()} == want


def test_widening_wraps_only_when_asked(spark):
    rows = clip(spark, on=flags(6, (0, 0)), last=[5] * 6)
    plain = rows.select("frame", intervals.widened(F.col("on"), KEY, 1).alias("w")).where("w").collect()
    assert sorted(r.frame for r in plain) == [0, 1]
    ring = rows.select("frame", intervals.widened_round(F.col("on"), KEY, 1, F.col("last")).alias("w")).where("w").collect()
    assert sorted(r.frame for r in ring) == [0, 1, 5]


def test_half_even_frames(spark):
    found = spark.range(1).select(*[intervals.frames_for(F.lit(s), 10).alias(str(i)) for i, s in enumerate((0.05, 0.25, 0.35))]).first()
    assert tuple(found) == (2, 2, 4)


def test_token_grid(spark):
    one = spark.createDataFrame([(1, 6, 3, 4)], "clip_uid int, frame int, y int, x int")
    grid = pixels.token_grid(one, one.withColumn("score", F.lit(0.8)), 13, 128, 128, 8).collect()
    assert [(r.f_lat, r.h_lat, r.w_lat, r.hit, r.peak) for r in grid] == [(2, 0, 0, True, 0.8)]
    assert grid[0]["mean"] == pytest.approx(0.8 / (4 * 16 * 16))
    with pytest.raises(ValueError):
        pixels.token_grid(one, one.withColumn("score", F.lit(1.0)), 24, 128, 128, 8)


def seg(spark, *rows):
    return spark.createDataFrame([(1, f, y, x, b, 9, 9, 9) for f, y, x, b in rows], "clip_uid int, frame int, y int, x int, body_id int, r int, g int, b int")


def test_a_static_body_hides_the_occupancy_signal(spark):
    valid, invalid = seg(spark, (1, 1, 1, 2), (1, 2, 1, 1)), seg(spark, (1, 1, 1, 1), (1, 2, 1, 1))
    ball, both = (spark.createDataFrame([(1, b) for b in ids], "clip_uid int, body_id int") for ids in ([2], [1, 2]))
    assert pixels.observable_frames(pixels.sides(valid, invalid, ball)).count() == 1
    assert pixels.observable_frames(pixels.sides(valid, invalid, both)).count() == 0


def test_the_mask_holds_where_a_body_was_and_is(spark):
    valid, invalid = seg(spark, (0, 0, 0, 2), (1, 0, 0, 2)), seg(spark, (0, 0, 0, 2), (1, 3, 3, 2))
    gate = spark.createDataFrame([(1, 1)], "clip_uid int, frame int")
    mask = pixels.violation_mask(valid, invalid, gate)
    assert sorted((r.frame, r.y, r.x) for r in mask.collect()) == [(1, 0, 0), (1, 3, 3)]
    assert pixels.outside(invalid.where("frame = 1").select(*pixels.PIXEL), mask).isEmpty()


def test_dilation_wraps(spark):
    corner = spark.createDataFrame([(1, 0, 0, 0)], "clip_uid int, frame int, y int, x int")
    assert {(r.y, r.x) for r in pixels.dilated(corner, 1, 4, 4).collect()} == {(y % 4, x % 4) for y in (-1, 0, 1) for x in (-1, 0, 1)}


def test_score_against_twin_counts_both_ways(spark):
    t = spark.createDataFrame([(5.0, 20.0), (20.0, 5.0), (5.0, 5.0)], "r double, twin double")
    assert [r.s for r in t.select(severity.score_against_twin(F.col("r"), F.col("twin"), F.lit(30.0)).alias("s")).collect()] == [0.5, 0.5, 0.0]


def test_greedy_pairs_use_a_body_once(spark):
    rows = [(1, 10, 11, 3, 0.5), (1, 10, 12, 3, 0.4), (1, 11, 13, 4, 0.1), (1, 14, 15, 9, 0.2), (2, 1, 2, 1, 0.1)]
    t = spark.createDataFrame(rows, "clip_uid long, body_a long, body_b long, frame int, gap double")
    got = {(r.clip_uid, r.body_a, r.body_b) for r in geometry.greedy_pairs(t, 2).collect()}
    assert got == {(1, 10, 12), (1, 11, 13), (2, 1, 2)}


def test_draws_do_not_depend_on_partitions(spark):
    t = spark.range(200)
    one = {r.id: r.u for r in t.coalesce(1).select("id", edits.draw(F.col("id"), salt="s").alias("u")).collect()}
    many = {r.id: r.u for r in t.repartition(7).select("id", edits.draw(F.col("id"), salt="s").alias("u")).collect()}
    assert one == many and len(set(one.values())) > 190 and all(0 <= u < 1 for u in one.values())


def test_colour_targets_are_as_far_as_wanted():
    rng = random.Random(3)
    for _ in range(60):
        rgb = tuple(rng.random() for _ in range(3))
        for wanted in edits.STRENGTHS["recolour"].values():
            if wanted <= 0.6:
                got = materials.colour_at_distance(rgb, wanted)
                far = float(((materials._lab(__import__("numpy").array(rgb)) - materials._lab(__import__("numpy").array(got))) ** 2).sum() ** 0.5) / 100
                assert far == pytest.approx(wanted, abs=1e-2)


def test_every_edit_keeps_the_lawful_prefix(spark, small):
    from lawtrace.plans.motion import sized

    valid = sized(spark, small).cache()
    who, t0 = F.col("body_id") % 15 == 3, F.col("t_event")
    made = [edits.teleport(valid, who, t0, 4.0), edits.halt(valid, who, t0), edits.time_slip(valid, who, t0, F.lit(4)), edits.squash(valid, who, t0, 2.0), edits.fade(valid, who, t0, F.lit(4)), edits.retime(valid, who, t0, 0.3), edits.hover(valid, who, t0, 2.0), edits.drop_out(valid, who, t0, t0 + 4)]
    for bad in made:
        assert twins.prefix_report(twins.aligned(valid, bad), tolerance=1e-9).where("not identical").isEmpty()
        assert twins.undeclared(twins.aligned(valid, bad), valid.where(who).select("clip_uid", "body_id").distinct()).isEmpty()


def test_means_of_supports_add_frames_in_order(spark):
    """Rows dealt in any order give the sum in order of frames, to the last bit; nulls do not count."""
    values = [0.1 * (i * 37 % 101) for i in range(70)]
    rows = [(1, f, v) for f, v in enumerate(values)] + [(1, 70, None), (2, 0, None)]
    t = spark.createDataFrame(rows[::-1], "body_id long, frame int, px double").repartition(3)
    got = dict(t.groupBy("body_id").agg(geometry.steady_mean("px").alias("m")).collect())
    total = 0.0
    for v in values:
        total += v
    assert got == {1: total / len(values), 2: None}


def test_twins_of_contamination_read_their_clips_a_few_times(spark, small):
    """Edits that join are not chained: their plan would double and treble with each, in the driver's memory and in the work."""
    from lawtrace.plans import contamination_queries

    plan = contamination_queries.law_contamination(spark, small)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [") <= 12


def test_only_touched_bodies_are_stacked_for_an_edit(spark, small):
    """Every edit had a twin of the whole clip, sixteen times its rows; bodies that no edit touches have their lawful rows alone, touched ones bring their neighbour."""
    from lawtrace.plans import contamination_queries, motion

    lawful = motion.sized(spark, small)
    rows = contamination_queries.staged(spark, small).select("clip_uid", "body_id").distinct().collect()
    assert contamination_queries.staged(spark, small).count() <= 4 * lawful.count()
    bodies = {r.body_id for r in lawful.select("body_id").distinct().collect()}
    of = {k: {r.body_id for r in rows if r.clip_uid % 16 == k} for k in range(16)}
    assert of[0] == bodies
    for k in range(1, 16):
        moved = {b for b in bodies if b % 15 == 3 or k == 15 and b % 15 == 4}
        assert of[k] == moved | {b ^ 1 for b in moved} & bodies


def test_medians_are_exact_without_a_task_for_each_group(spark, small):
    import statistics

    from lawtrace.plans import motion

    rng = random.Random(2)
    rows = [(g, round(rng.lognormvariate(0, 3), rng.choice((0, 6)))) for g, n in (("a", 1), ("b", 2), ("c", 3), ("d", 500), ("e", 3001)) for _ in range(n)] + [("a", None), ("z", None)]
    found = severity.noise_floor(spark.createDataFrame(rows, "g string, r double"), ["g"])
    got = {x["g"]: (x["mu"], x["sigma"], x["n"]) for x in found.collect()}
    want = {"z": (None, None, 0)}
    for g in "abcde":
        v = [r for k, r in rows if k == g and r is not None]
        mu = statistics.median(v)
        want[g] = (mu, 1.4826 * statistics.median(abs(r - mu) for r in v), len(v))
    assert got.keys() == want.keys() and all(got[g][2] == w[2] and (got[g][:2] == w[:2] or got[g][:2] == pytest.approx(w[:2], rel=1e-12)) for g, w in want.items())
    # every value of a group in one task, and every row of it in another, is what a join or a median by group would take
    assert "SortMergeJoin" not in motion.noise_scores(spark, small)._jdf.queryExecution().executedPlan().toString()


def test_dilation_wraps_without_a_table_of_spread_rows(spark):
    import re

    rng = random.Random(4)
    mask = {(c, f, rng.randrange(7), rng.randrange(11)) for c in (1, 2) for f in range(3) for _ in range(f * 4)}
    found = pixels.dilated(spark.createDataFrame(sorted(mask), "clip_uid long, frame int, y int, x int"), 2, 7, 11)
    want = {(c, f, (y + dy) % 7, (x + dx) % 11) for c, f, y, x in mask for dy in range(-2, 3) for dx in range(-2, 3)}
    got = [tuple(x) for x in found.collect()]
    assert len(got) == len(want) and set(got) == want
    assert not re.search(r"(?<!Object)HashAggregate", found._jdf.queryExecution().executedPlan().toString())


def test_colours_at_a_distance_at_once(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    colours = np.concatenate([rng.random((200, 3)), [[0, 0, 0], [1, 1, 1], [0.5, 0.5, 0.5], [1, 0, 0]]])
    for wanted in (0.1, 0.25, 5.0):
        one = np.array([materials.colour_at_distance(tuple(c), wanted) for c in colours])
        assert np.allclose(materials.colours_at_distance(colours, wanted), one, atol=1e-9)


def test_laws_sort_the_rows_of_clips_twice(spark, small):
    import re

    from lawtrace.operators import laws
    from lawtrace.plans import motion, views

    rows = laws.wide(views.traj(spark, small), views.contacts(spark, small), views.FPS, motion.CTX, motion.G)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bSort \[clip_uid", plan)) == 2
