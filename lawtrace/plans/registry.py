"""Queries over the driver's tables and the SQL they are held against."""

from __future__ import annotations

from lawtrace.plans import annotation_queries, choice_queries, contamination_queries, frames, geometry_queries, look_queries, motion, pixel_queries, release_queries, staging_queries  # noqa: F401
from lawtrace.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark, sf_dir):
    return motion.teleport_severity(spark, sf_dir)
