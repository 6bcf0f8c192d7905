"""stratum — medallion-style incident analytics as parameterised Spark DataFrame operators.

Layers: raw JSON landing -> bronze (all strings) -> silver (typed, cleaned, one row per id)
-> gold (calendar, location and vehicle dimensions, fact, monthly and area rollups), every
table guarded by declarative checks. Every operator is a ``DataFrame -> DataFrame`` (or
``Column``) function; planning is left to Catalyst and adaptive execution.
"""

from stratum.session import cluster_conf, get_spark, scratch_path

__all__ = ["cluster_conf", "get_spark", "scratch_path"]
