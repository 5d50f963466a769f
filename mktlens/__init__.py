"""mktlens: marketplace acquisition and fulfilment analytics on Spark.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``   raw table contracts, readers, test-data adapters, sinks
* ``functions`` shared column expressions (cleaning, exact rounding, dates)
* ``operators`` reusable distributed operators (ranking, joins, checks)
* ``plans``     staging, marts, analyses, quality checks, profiler, KPIs
"""

__all__ = ["functions", "operators", "plans", "sources"]
