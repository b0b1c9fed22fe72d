"""costmart: a multi-cloud billing mart built as Spark DataFrame plans.

Layout: ``sources`` (export readers, driver-table projections), ``operators`` (normalise,
dimensions, fact, quality), ``functions`` (column expressions and fixed lookups), ``plans``
(the mart pipeline, reports, named queries), ``sinks`` (stored mart layout, upserts),
``streaming`` (incremental ingest of new export files).
"""

__version__ = "0.1.0"
