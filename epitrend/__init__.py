"""epitrend: cumulative daily reports per entity, cleaned, rolled up and
analysed as Spark DataFrame plans."""

__version__ = "0.1.0"
