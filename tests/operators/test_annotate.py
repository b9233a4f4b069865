"""Annotations of pairs: gates by loops over one clip, and tables written, read back and replaced."""

import random

from pyspark.sql import functions as F

from lawtrace.operators import annotate
from lawtrace.sources import annotated

CELLS = "clip_uid long, frame int, y int, x int, body_v long, r_v int, g_v int, b_v int, body_i long, r_i int, g_i int, b_i int"
WINDOWS = "array<struct<s: int, e: int>>"
PLANS = f"clip_uid long, frames int, detectable string, strong double, r_strong double, t_event int, violation_windows {WINDOWS}, intervention_windows {WINDOWS}, consequence_windows {WINDOWS}, culprits array<long>, primary long, static_ids array<long>, moved array<long>"
MOTION = "clip_uid long, frame int, score double, diverged boolean, absent boolean"
T, H, W = 13, 8, 8


def corpus(seed, clips=6):
    rng = random.Random(seed)
    cells, plans, motion = [], [], []
    for c in range(clips):
        start = rng.randrange(2, 7)
        windows = [(start, start + rng.randrange(1, 4))] + ([(start + 5, start + 6)] if c % 2 else [])
        plans.append((c, T, rng.choice(["event", "state"]), 2.0, rng.choice([None, 0.0, 1.5]), start, windows, rng.choice([None, [(start, start + 1)]]), rng.choice([None, [(start + 1, T + 5)]]), [1, 4], 1, [3], [2] if c % 3 else []))
        for t in range(T):
            motion.append((c, t, rng.choice([0.0, 0.3, 0.9]), rng.random() < 0.3 and t >= start, rng.random() < 0.2))
            hidden, same = rng.random() < 0.4, rng.random() < 0.4
            for place in rng.sample(range(H * W), rng.randrange(0, 14)):
                own = rng.choice([1, 2, 3, 4])
                v = (own, rng.randrange(256), 0, 5) if rng.random() < 0.8 else (None,) * 4
                i = v if same else (rng.choice([1, 2, 3]), rng.randrange(256), 0, 5) if rng.random() < 0.8 else (None,) * 4
                if hidden and i[0] in (1, 4):
                    i = (None,) * 4
                if v[0] or i[0]:
                    cells.append((c, t, place // W, place % W, *v, *i))
    return cells, plans, motion


def placed(score, active, shown):
    gate, out, t = [False] * len(score), [0.0] * len(score), 0
    while t < len(score):
        if not active[t]:
            t += 1
            continue
        best, seen = 0.0, False
        while t < len(score) and active[t]:
            best = max(best, score[t])
            if shown[t]:
                gate[t], out[t], best, seen = True, best, 0.0, True
            t += 1
        after = t
        while not seen and after < len(score) and not active[after]:
            if shown[after]:
                gate[after], out[after], seen = True, best, True
            after += 1
    return gate, out


def by_loops(cells, plans, motion):
    """{(clip, side, annotation, frame, y, x): value} of everything but divergence and segmentation."""
    out = {}
    for c, frames, kind, _, _, _, violation, made, lasting, culprits, _, static, moved in plans:
        at = {t: {(y, x): (v, i, max(abs((a or 0) - (b or 0)) for a, b in zip(rv, ri))) for cc, tt, y, x, v, *rv, i, r1, r2, r3 in cells if cc == c and tt == t for rv, ri in [(rv[:3], (r1, r2, r3))]} for t in range(frames)}
        inside = lambda w, t: any(s <= t <= e for s, e in w)
        state = {t: (s, d, a) for cc, t, s, d, a in motion if cc == c}
        observable, seen_i = [], []
        for t in range(frames):
            own = [(v in culprits, i in culprits, v is not None and i is not None and off >= annotate.LEVEL) for v, i, off in at[t].values() if v in culprits or i in culprits]
            observable.append(any(a != b for a, b, _ in own) or sum(x for _, _, x in own) >= annotate.LEAST)
            seen_i.append(any(b for _, b, _ in own))
        scored = [inside((made or violation) if kind == "event" else (lasting or violation), t) for t in range(frames)]
        score = [state[t][0] for t in range(frames)]
        visible, s_visible = placed(score, scored, observable)
        visible_inv, s_inv = placed(score, scored, [a and b for a, b in zip(observable, seen_i)])
        for t in range(frames):
            causal = (inside(lasting or violation, t) or state[t][1]) and observable[t]
            gone = visible[t] and state[t][2] and not (visible_inv[t] and seen_i[t])
            prim = {p for p, (_, i, _) in at[t].items() if i in culprits}
            for (y, x), (v, i, _) in at[t].items():
                put = lambda side, name, value: out.__setitem__((c, side, name, t, y, x), value)  # noqa: B023, E731
                if v in culprits:
                    put("valid", "reference_mask", 1.0), put("invalid", "reference_mask", 1.0)
                if (visible[t] or visible_inv[t]) and (v in culprits or i in culprits):
                    put("invalid", "violation_mask", 1.0)
                if visible_inv[t] and i in culprits:
                    put("invalid", "mask_invalid", 1.0)
                severity = s_inv[t] if i in culprits and visible_inv[t] else s_visible[t] if v in culprits and gone else 0.0
                if severity:
                    put("invalid", "severity_map", severity)
                near = any(((y + dy) % H, (x + dx) % W) in prim for dy in range(-3, 4) for dx in range(-3, 4))
                if causal and (i in culprits or i in moved or (i in static and near)):
                    put("invalid", "causal_mask", 1.0 if i in culprits else 2.0)
    return out


def read(spark, path, *skip):
    rows = spark.read.parquet(f"{path}/pixels").where(~F.col("annotation").isin(*skip) if skip else F.lit(True)).collect()
    out = {(r["clip_uid"], r["side"], r["annotation"], r["frame"], r["y"], r["x"]): r["value"] for r in rows}
    assert len(out) == len(rows)
    return out


def frames_of(spark, *tables):
    return [spark.createDataFrame(t, s) for t, s in zip(tables, (CELLS, PLANS, MOTION))]


def test_written_annotations_and_replaced_clips(spark, tmp_path):
    tables = corpus(4)
    cells, plans, motion = frames_of(spark, *tables)
    path = str(tmp_path / "release")

    def of(m):
        return lambda p: m.join(p.select("clip_uid"), "clip_uid", "left_semi")

    annotated.annotate_release(cells, plans, of(motion), path, H, W, batches=3)
    first = read(spark, path)
    extra = ("seg", "divergence_map")
    assert {k: v for k, v in first.items() if k[2] not in extra} == by_loops(*tables)
    assert {k for k in first if k[2] == "seg"} == {(c, s, "seg", t, y, x) for c, t, y, x, v, *_, i, _, _, _ in tables[0] for s, b in (("valid", v), ("invalid", i)) if b is not None}
    times = spark.read.parquet(f"{path}/timelines").count()
    assert times == 6 * T

    chosen = spark.createDataFrame([(2,), (3,)], "clip_uid long")
    annotated.reannotate(cells, plans, of(motion), chosen, path, H, W, batches=3)
    assert read(spark, path) == first and spark.read.parquet(f"{path}/timelines").count() == times

    # clip 2 now has no violation at all, and clip 3 another motion: only their rows change, and folders without rows go
    later = [(*p[:6], [], [], [], *p[9:]) if p[0] == 2 else p for p in tables[1]]
    other = [(c, t, 0.5, False, False) if c in (2, 3) else (c, t, *m) for c, t, *m in tables[2]]
    cells, plans, motion = frames_of(spark, tables[0], later, other)
    annotated.reannotate(cells, plans, of(motion), chosen, path, H, W, batches=3)
    second = read(spark, path)
    assert {k: v for k, v in second.items() if k[2] not in extra} == by_loops(tables[0], later, other)
    assert {k: v for k, v in second.items() if k[0] not in (2, 3)} == {k: v for k, v in first.items() if k[0] not in (2, 3)}
    assert not any(k[0] == 2 and k[2] in ("violation_mask", "severity_map", "mask_invalid") for k in second)


def test_folders_without_rows_are_removed(spark, tmp_path):
    tables = corpus(9, clips=1)
    cells, plans, motion = frames_of(spark, *tables)
    path = str(tmp_path / "one")
    annotated.annotate_release(cells, plans, lambda p: motion, path, H, W, batches=2)
    assert any(k[2] == "violation_mask" for k in read(spark, path))
    quiet = spark.createDataFrame([(*p[:6], [], [], [], *p[9:]) for p in tables[1]], PLANS)
    still = motion.withColumn("diverged", F.lit(False))
    for _ in range(2):
        annotated.reannotate(cells, quiet, lambda p: still, quiet.select("clip_uid"), path, H, W, batches=2)
        assert {k[2] for k in read(spark, path)} == {"seg", "reference_mask", "divergence_map"}


def test_energy_of_both_sides(spark, tmp_path):
    tables = corpus(5, clips=2)
    cells, plans, motion = frames_of(spark, *tables)
    energies = spark.createDataFrame([(c, s, t, b, 0.25 * b if s == "valid" else -1.0) for c in range(2) for s in ("valid", "invalid") for t in range(T) for b in (1, 3)], "clip_uid long, side string, frame int, body_id long, share double")
    rows, _ = annotate.annotate_pairs(cells, plans, motion, H, W, energies)
    got = {(r["clip_uid"], r["side"], r["frame"], r["y"], r["x"]): r["value"] for r in rows.where("annotation = 'energy_map'").collect()}
    want = {(c, "valid", t, y, x): 0.25 * v for c, t, y, x, v, *_ in tables[0] if v in (1, 3)} | {(c, "invalid", t, y, x): -1.0 for c, t, y, x, *rest in tables[0] if rest[4] in (1, 3)}
    assert got == want


def test_audits_read_their_cells_a_few_times(spark, small):
    """One pass over painted cells: before, the severity, the mask, the divergence and the frames each made the cells anew."""
    from lawtrace.plans import pixel_queries

    plan = pixel_queries.audit_measure(spark, small)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [") <= 6
