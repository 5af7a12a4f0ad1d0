"""starmart: a Spark-native retail star-schema pipeline.

Layers (each a plain ``DataFrame -> DataFrame`` function, planned by Catalyst):

* ``sources``   – raw order-line readers, validation, freshness, table publish
* ``functions`` – column expressions (safe casts, surrogate keys, calendar parts)
* ``operators`` – staging, metrics, calendar, SCD2 history, point-in-time fact,
                  incremental upsert, data-quality checks, analytic marts
* ``streaming`` – micro-batch fact upsert over a file stream
* ``plans``     – the end-to-end build order and the registered queries
"""

from starmart.config import PipelineConfig

__all__ = ["PipelineConfig"]
