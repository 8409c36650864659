"""Cohort monitoring on Spark: record tables in, summary tables out."""
