"""panelkit: entity-by-year panels, economic indicators and value models on Spark.

Everything is a ``DataFrame -> DataFrame`` (or ``-> Column``) function built on
Spark SQL / DataFrame / ``pyspark.ml`` so Catalyst plans the whole pipeline.

Sub-packages:

* ``sources``   - CSV / text / Parquet readers and writers (S01-S14)
* ``functions`` - column expressions: predicates, text helpers, date buckets
* ``operators`` - keys, encoders, panel joins, indicator aggregates, quality,
                  features, models and evaluation
* ``plans``     - the composite pipelines (C01-C08) and the stand-in inputs
                  derived from the driver's test tables
* ``streaming`` - nothing: the workload has no streaming part (see README)
"""

from panelkit.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
