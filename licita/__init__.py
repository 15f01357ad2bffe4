"""Procurement analytics on Spark.

Layers: landing sheets -> staging (partitioned Parquet) -> curated star
(current versions, organisation master, fact, bridge, dimensions) ->
warehouse (surrogate keys, typed columns) -> quality controls.  Every step is
a DataFrame transformation; nothing is collected to the driver.
"""

__version__ = "0.1.0"
