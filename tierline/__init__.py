"""tierline: layered (bronze, silver, gold) advertising analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
DataFrame / SQL primitives; nothing here runs row-level Python.

Layout:

* ``tierline.rules``       entity registry, rule lookup, dependency order
* ``tierline.functions``   column-level helpers (casts, trims, URL fix, flags)
* ``tierline.operators``   table operators (dedup, FK flags, funnel, ranks, pivot, metrics)
* ``tierline.sources``     table sinks / scans (overwrite, create, upsert, schemas, JSON)
* ``tierline.streaming``   incremental file load (Structured Streaming, availableNow)
* ``tierline.plans``       pipelines: bronze load, silver build, gold tables, run-all
* ``tierline.testbed``     six-entity raw views derived from the driver's tables
"""

__version__ = "0.1.0"
