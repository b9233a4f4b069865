"""Noise floors, scores against the lawful twin, and peaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawtrace.functions.vectors import at_least, clip


#: Half the width, in shares of a group, of the bracket about its median, and the accuracy of its ends: twenty times finer.
BRACKET, ACCURACY = 0.002, 10_000


def exact_median(rows: DataFrame, group: list[str], value: Column) -> DataFrame:
    """``group`` with the exact median of its values and n, their number, while no task holds more of a group than about a 250th.

    Approximate quantiles, whose error in rank is at most ``n / ACCURACY``, hold the median between them. Values beyond are set to the
    nearer end, which leaves the median where it is; then equal ones are counted together. Groups are few: their ends are broadcast."""
    t = rows.select(*group, value.alias("v")).where("v is not null")
    ends = t.groupBy(*group).agg(F.percentile_approx("v", [0.5 - BRACKET, 0.5 + BRACKET], ACCURACY).alias("ends"))
    held = t.join(F.broadcast(ends), group).withColumn("v", F.least(F.greatest(F.col("v"), F.get("ends", F.lit(0))), F.get("ends", F.lit(1))))
    counted = held.groupBy(*group, "v").agg(F.count("*").alias("times"))
    return counted.groupBy(*group).agg(F.percentile("v", F.lit(0.5), F.col("times")).alias("median"), F.sum("times").alias("n"))


def noise_floor(residuals: DataFrame, group: list[str], value: str = "r") -> DataFrame:
    """``group`` with mu (exact median), sigma (1.4826 times the median absolute deviation), sigma_eff and n. A group without any value has nulls."""
    mu = exact_median(residuals, group, F.col(value)).select(*group, F.col("median").alias("mu"))
    off = exact_median(residuals.join(F.broadcast(mu), group), group, F.abs(F.col(value) - F.col("mu")))
    known = mu.join(F.broadcast(off), group).select(*group, "mu", (1.4826 * F.col("median")).alias("sigma"), "n")
    every = residuals.select(*group).dropna().distinct()
    return every.join(F.broadcast(known), group, "left").na.fill(0, ["n"]).withColumn("sigma_eff", at_least(F.col("sigma"), 1e-3))


def z_score(value: Column) -> Column:
    return (value - F.col("mu")) / F.col("sigma_eff")


def score_against_twin(value: Column, twin: Column, strong: Column) -> Column:
    return clip(F.abs(value - twin) / at_least(strong, 1e-9), 0, 1)


def score_against_floor(value: Column, mu: Column, strong: Column) -> Column:
    return clip((value - mu) / at_least(strong - mu, 1e-9), 0, 1)


def peak(rows: DataFrame, group: list[str], value: str = "r", frame: str = "frame", carry: tuple[str, ...] = (), more: tuple[Column, ...] = ()) -> DataFrame:
    """The row of the largest value of each group, the earliest on ties, with ``more`` aggregates of the group."""
    at = F.struct(F.col(value), -F.col(frame))
    return rows.groupBy(*group).agg(F.max(value).alias("peak"), F.max_by(frame, at).alias("peak_frame"), *[F.max_by(c, at).alias(c) for c in carry], *more)
