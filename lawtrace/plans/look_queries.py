"""Queries on materials and colour targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.functions import vectors as V
from lawtrace.operators import materials
from lawtrace.plans import views
from lawtrace.plans.catalog import query, r, tidy

NAMES = tuple(materials.DENSITY)
KINDS = ("sphere", "cube", "cylinder", "cone", "torus")
_d = f"{[float(x) for x in materials.DENSITY.values()]!r}[(p_partkey % 7 + 1)::int]"
_v = "case p_partkey % 5 when 0 then 4 / 3e0 * pi() * a * b * c when 2 then pi() * a * b * 2 * c when 3 then pi() * a * b * 2 * c / 3 when 4 then 2 * pi() * pi() * (a * 0.75e0) * (a * 0.25e0) * (a * 0.25e0) else 8 * a * b * c end"


def _bodies(spark, sf_dir):
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (F.col("p_partkey") % n + 1).cast("int"))
    return views.table(spark, sf_dir, "part").select("p_partkey", pick(NAMES, 7).alias("material"), pick(KINDS, 5).alias("kind"), (F.col("p_size") / 50.0).alias("sx"), (F.col("p_size") / 40.0).alias("sy"), (F.col("p_size") / 30.0).alias("sz"), (F.col("p_partkey") % 100 / 100.0).alias("hue"))


@query(f"with s as (select p_partkey, p_size / 50e0 as a, p_size / 40e0 as b, p_size / 30e0 as c from part) select p_partkey, {r(f'{_d}::double * ({_v}) / 250', 'mass')}, {r(f'{_d}::double / 650e0', 'ratio')} from s")
def material_mass(spark, sf_dir):
    b = _bodies(spark, sf_dir)
    return tidy(b.select("p_partkey", materials.mass(F.col("material"), F.col("kind"), V.vec("s")).alias("mass"), (materials.density(F.col("material")) / materials.DENSITY["wood"]).alias("ratio")))


_red = "0.88e0 - 0.88e0 * 0.62e0 * greatest(0, least((5 + h * 6) - 6 * floor((5 + h * 6) / 6), 4 - ((5 + h * 6) - 6 * floor((5 + h * 6) / 6)), 1))"


@query(f"""with s as (select p_partkey, p_size / 50e0 as a, p_size / 40e0 as b, p_size / 30e0 as c, (p_partkey % 100) / 100e0 as h, p_partkey % 4 <> 0 and p_partkey % 6 <> 5 as flat, p_partkey % 6 <> 5 as has from part)
select p_partkey, {r(f'case when flat then 650e0 * ({_v}) / 250 else 7e0 end', 'mass')}, case when has and not flat then {list(NAMES)!r}[(p_partkey % 7 + 1)::int] end as material, {r(f'case when flat then {_red} else 0.1e0 end', 'cr')} from s""")
def material_flattened(spark, sf_dir):
    """Bodies of levels without materials; a quarter of the scenes shows them, and a sixth of the bodies has none."""
    b = _bodies(spark, sf_dir).withColumns({"material": F.when(F.col("p_partkey") % 6 != 5, F.col("material")), "cr": F.lit(0.1), "mass": F.lit(7.0)})
    t = materials.flattened(b, F.col("hue"), F.col("kind"), V.vec("s"), F.col("p_partkey") % 4 != 0)
    return tidy(t.select("p_partkey", "mass", "material", "cr"))


@query()
def recolour_distance(spark, sf_dir):
    """For the colour of each vector a target at a perceived distance of 0.25, and how far it is: a bisection, so without SQL; tested by its distances."""
    e = views.table(spark, sf_dir, "embeddings").where("embedding is not null").selectExpr("vec_id", *[f"least(greatest(abs(cast(embedding[{i}] as double)) * 2, 0e0), 1e0) as c{c}" for i, c in enumerate("rgb")])
    t = materials.recolour_targets(e, 0.25)
    return tidy(t.select("vec_id", "cr", "cg", "cb", "tr", "tg", "tb", V.lab_distance(V.vec("c", "rgb"), V.vec("t", "rgb")).alias("distance")))
