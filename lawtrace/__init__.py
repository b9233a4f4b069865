"""Trajectory annotation, twin comparison and dataset release jobs as Spark DataFrame plans."""
