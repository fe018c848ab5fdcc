"""Strata: raw, cleaned and curated data-lake layers as Spark DataFrame operators."""
