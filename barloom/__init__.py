"""barloom: market-signal analytics expressed as Spark DataFrame / SQL plans.

Sub-packages
------------
sources    typed scans, fixture derivation from the test tables, sinks
functions  column helpers: guards, portable rounding, code maps, EMA
operators  features, labels, splits, metrics, signals, outcomes, sentiment,
           profiling, preprocessing, thresholds and MLlib training
plans      composed pipelines (feature table, scoring, feedback loop) and the
           query catalogue used by ``__spark_entry__``
streaming  incremental outcome scoring over a stream of predictions
"""

__version__ = "0.1.0"
