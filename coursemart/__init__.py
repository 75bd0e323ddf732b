"""coursemart: enrollment analytics as plain PySpark DataFrame / Spark SQL jobs.

Layers (each a function from DataFrames to a DataFrame):

* ``sources``   – landing (full / incremental / insert-if-absent), staging projections,
                  table IO with delete+insert upserts, and the driver-table binding.
* ``operators`` – SCD2 snapshots, conformed dims, incremental facts, wide analysis
                  tables (OBT), derived marks/grades and the data-quality suite.
* ``plans``     – dashboard aggregates and the end-to-end pipeline.
* ``streaming`` – the landing and upsert operators as Structured Streaming jobs.
* ``functions`` – column expressions shared by all layers.
"""

from coursemart.params import Params

__all__ = ["Params"]
