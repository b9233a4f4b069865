"""Masses by material and shape, flattened looks, and colour targets."""

from __future__ import annotations

import colorsys

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: FIXED VALUES: densities of the materials, in kilograms for each cubic metre, and the scale of masses.
DENSITY = {"cork": 240.0, "wood": 650.0, "plastic": 1100.0, "rubber": 1300.0, "ceramic": 2400.0, "stone": 2700.0, "steel": 7800.0}
MASS_SCALE = 250.0


def volume(kind: Column, s: tuple[Column, ...]) -> Column:
    """Volume for the half extents ``s``; unknown kinds count as boxes."""
    a, b, c = s
    tube, ring = a * 0.25, a * 0.75
    return F.when(kind == "sphere", 4 / 3 * F.pi() * a * b * c).when(kind == "cylinder", F.pi() * a * b * 2 * c).when(kind == "cone", F.pi() * a * b * 2 * c / 3).when(kind == "torus", 2 * F.pi() * F.pi() * ring * tube * tube).otherwise(8 * a * b * c)


def density(material: Column) -> Column:
    """Of a known material, else of wood."""
    out = F.when(F.lit(False), 0.0)
    for name, value in DENSITY.items():
        out = out.when(material == name, value)
    return out.otherwise(DENSITY["wood"])


def mass(material: Column, kind: Column, s: tuple[Column, ...]) -> Column:
    return density(material) * volume(kind, s) / MASS_SCALE


def flattened(bodies: DataFrame, hue: Column, kind: Column, s: tuple[Column, ...], flat: Column | None = None) -> DataFrame:
    """Bodies with their hue at one saturation and value, the mass of the reference material, and no material.

    ``flat`` says of which rows, those of scenes whose level shows no materials; a body without a material is as it was in any case."""
    from lawtrace.functions.vectors import from_hue

    changes = F.col("material").isNotNull() if flat is None else flat & F.col("material").isNotNull()
    new = {**{f"c{c}": x for c, x in zip("rgb", from_hue(hue, 0.62, 0.88))}, "mass": mass(F.lit("wood"), kind, s)}
    kept = {c: F.when(changes, x).otherwise(F.col(c)) if c in bodies.columns else F.when(changes, x) for c, x in new.items()}
    return bodies.withColumns({**kept, "material": F.when(~changes, F.col("material"))})


def _lab(rgb: np.ndarray) -> np.ndarray:
    from lawtrace.functions.vectors import SRGB_TO_XYZ, WHITE

    c = np.clip(rgb, 0, 1)
    xyz = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4) @ np.array(SRGB_TO_XYZ).T / np.array(WHITE)
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    return np.array([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])])


def colour_at_distance(rgb: tuple[float, float, float], wanted: float, steps: int = 20) -> tuple[float, float, float]:
    """A colour about ``wanted`` Lab hundredths away, by bisection: on the hue while half a turn is far enough, else on
    the way to the farthest corner of the colour cube. A distance beyond that corner gives the corner."""
    start = np.clip(np.array(rgb, float), 0, 1)
    h, s, v = colorsys.rgb_to_hsv(*start)
    turned = lambda x: np.array(colorsys.hsv_to_rgb((h + 0.5 * x) % 1.0, s, v))
    distance = lambda c: float(np.linalg.norm(_lab(c) - _lab(start))) / 100
    corner = max((np.array([r, g, b], float) for r in (0, 1) for g in (0, 1) for b in (0, 1)), key=distance)
    path = turned if distance(turned(1.0)) >= wanted else lambda x: start + (corner - start) * x
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if distance(path(middle)) < wanted else (low, middle)
    return tuple(float(x) for x in path(high))


def _turned(h: np.ndarray, s: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``colorsys.hsv_to_rgb`` of many colours."""
    i = np.floor(h * 6).astype(int)
    f = h * 6 - i
    p, q, t = v * (1 - s), v * (1 - s * f), v * (1 - s * (1 - f))
    parts = ((v, q, p, p, t, v), (t, v, v, q, p, p), (p, p, t, v, v, q))
    return np.stack([np.choose(i % 6, c) for c in parts], axis=1)


def colours_at_distance(rgb: np.ndarray, wanted: float, steps: int = 20) -> np.ndarray:
    """``colour_at_distance`` of many colours at once, row by row."""
    start = np.clip(np.asarray(rgb, float), 0, 1).reshape(-1, 3)
    if not len(start):
        return start
    h, s, v = np.array([colorsys.rgb_to_hsv(*c) for c in start.tolist()]).T
    lab = lambda c: np.stack(_lab(c), axis=1)
    here = lab(start)
    distance = lambda c: np.linalg.norm(lab(c) - here, axis=1) / 100
    corners = np.array([[r, g, b] for r in (0, 1) for g in (0, 1) for b in (0, 1)], float)
    far = corners[np.argmax(np.stack([distance(np.broadcast_to(c, start.shape)) for c in corners]), axis=0)]
    turns = distance(_turned((h + 0.5) % 1.0, s, v)) >= wanted
    path = lambda x: np.where(turns[:, None], _turned((h + 0.5 * x) % 1.0, s, v), start + (far - start) * x[:, None])
    low, high = np.zeros(len(start)), np.ones(len(start))
    for _ in range(steps):
        middle = (low + high) / 2
        near = distance(path(middle)) < wanted
        low, high = np.where(near, middle, low), np.where(near, high, middle)
    return path(high)


def recolour_targets(colours: DataFrame, wanted: float) -> DataFrame:
    """``colours`` (cr, cg, cb) with (tr, tg, tb) at ``wanted`` distance, found once for each distinct colour."""

    def found(batches):
        for batch in batches:
            out = colours_at_distance(batch[["cr", "cg", "cb"]].to_numpy(), wanted)
            yield batch.assign(**{n: out[:, i] for i, n in enumerate(("tr", "tg", "tb"))})

    distinct = colours.select("cr", "cg", "cb").distinct()
    targets = distinct.mapInPandas(found, "cr double, cg double, cb double, tr double, tg double, tb double")
    return colours.join(targets, ["cr", "cg", "cb"])
