"""Layered record pipelines on Spark: landing -> conformed -> enriched -> reporting."""

LAYERS = ("landing", "conformed", "enriched", "reporting")
