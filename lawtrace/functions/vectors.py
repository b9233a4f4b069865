"""Vector, colour and easing expressions; everything is a column expression inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, ...]


def vec(prefix: str, parts: str = "xyz") -> Vec:
    return tuple(F.col(f"{prefix}{p}") for p in parts)


def dot(a: Vec, b: Vec) -> Column:
    return reduce(lambda x, y: x + y, [p * q for p, q in zip(a, b)])


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def sub(a: Vec, b: Vec) -> Vec:
    return tuple(p - q for p, q in zip(a, b))


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def at_least(x: Column, least: float) -> Column:
    return F.greatest(x, F.lit(float(least)))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high)))


def world_to_body(q: Vec, v: Vec) -> Vec:
    """Transposed rotation of the normalised quaternion (w, x, y, z); a zero quaternion leaves ``v`` unrotated."""
    n = norm(q)
    w, x, y, z = (F.when(n > 1e-12, p / n).otherwise(F.lit(1.0 if i == 0 else 0.0)) for i, p in enumerate(q))
    rows = (
        (1 - 2 * (y * y + z * z), 2 * (x * y + w * z), 2 * (x * z - w * y)),
        (2 * (x * y - w * z), 1 - 2 * (x * x + z * z), 2 * (y * z + w * x)),
        (2 * (x * z + w * y), 2 * (y * z - w * x), 1 - 2 * (x * x + y * y)),
    )
    return tuple(dot(r, v) for r in rows)


def spun(q: Vec, omega: Vec, seconds: Column) -> Vec:
    """``q`` after turning at the constant rate ``omega``: one closed expression for any number of frames."""
    rate = norm(omega)
    half = rate * seconds / 2
    s = F.when(rate > 1e-12, F.sin(half) / rate).otherwise(F.lit(0.0))
    w, x, y, z = F.cos(half), *(s * o for o in omega)
    a, b, c, d = q
    return w * a - x * b - y * c - z * d, w * b + x * a + y * d - z * c, w * c - x * d + y * a + z * b, w * d + x * c - y * b + z * a


#: FIXED VALUES of the sRGB and CIE-Lab (D65) definitions.
SRGB_TO_XYZ = ((0.4124, 0.3576, 0.1805), (0.2126, 0.7152, 0.0722), (0.0193, 0.1192, 0.9505))
WHITE = (0.95047, 1.0, 1.08883)


def lab(rgb: Vec) -> Vec:
    linear = []
    for c in (clip(c, 0, 1) for c in rgb):
        linear.append(F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4))))
    xyz = [dot(tuple(map(F.lit, row)), tuple(linear)) / white for row, white in zip(SRGB_TO_XYZ, WHITE)]
    f = [F.when(v > 0.008856, F.cbrt(v)).otherwise(7.787 * v + 16.0 / 116.0) for v in xyz]
    return 116.0 * f[1] - 16.0, 500.0 * (f[0] - f[1]), 200.0 * (f[1] - f[2])


def lab_distance(a: Vec, b: Vec) -> Column:
    return norm(sub(lab(a), lab(b))) / 100


def hue(rgb: Vec) -> Column:
    """Hue in 0..1; grey has hue 0."""
    r, g, b = rgb
    high, low = F.greatest(*rgb), F.least(*rgb)
    span = F.when(high > low, high - low)
    sixth = F.when(high == r, (g - b) / span).when(high == g, 2 + (b - r) / span).otherwise(4 + (r - g) / span)
    turn = F.coalesce(sixth / 6, F.lit(0.0))
    return turn - F.floor(turn)


def from_hue(h: Column, s: float, v: float) -> Vec:
    """HSV to RGB for fixed saturation and value."""
    def channel(n: int) -> Column:
        k = F.lit(float(n)) + h * 6
        k = k - 6 * F.floor(k / 6)
        return F.lit(v) - v * s * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0)))

    return channel(5), channel(3), channel(1)


#: FIXED VALUES: colour names by eighths of the hue circle.
COLOURS = ("red", "orange", "yellow", "green", "teal", "blue", "purple", "pink")


def colour_name(rgb: Vec) -> Column:
    return F.element_at(F.array(*map(F.lit, COLOURS)), (F.pmod(F.bround(hue(rgb) * 8).cast("int"), F.lit(8)) + 1).cast("int"))


def smoothstep(u: Column) -> Column:
    u = clip(u, 0, 1)
    return u * u * (3 - 2 * u)


def inertia(kind: Column, s: Vec) -> Vec:
    """Principal moments of unit mass for the half extents ``s``; unknown kinds count as spheres."""
    a, b, c = s
    mean = (a + b + c) / 3
    big, tube = a * 0.75, a * 0.25
    box = ((b * b + c * c) / 3, (a * a + c * c) / 3, (a * a + b * b) / 3)
    side = (3 * a * a + 4 * c * c) / 12
    lean = 3.0 / 20.0 * a * a + 3.0 / 80.0 * (2 * c) * (2 * c)
    ring = 5.0 / 8.0 * tube * tube + 0.5 * big * big
    shapes = {"cube": box, "box": box, "cylinder": (side, side, 0.5 * a * a), "cone": (lean, lean, 0.3 * a * a), "torus": (ring, ring, 0.75 * tube * tube + big * big)}
    out = []
    for i in range(3):
        expr = F.when(F.lit(False), F.lit(0.0))
        for name, moments in shapes.items():
            expr = expr.when(kind == name, moments[i])
        out.append(expr.otherwise(0.4 * mean * mean))
    return tuple(out)


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounded, with one kind of zero."""
    return F.round(x, digits) + F.lit(0.0)
