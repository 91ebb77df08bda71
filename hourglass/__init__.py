"""hourglass: irregular per-stay event records -> model-ready tables on Spark.

Sub-packages
------------
sources    scans, sinks and the adapters onto the test tables
functions  column expressions (scalar functions)
operators  DataFrame -> DataFrame operators (filters, joins, aggregates,
           time series, static encoding, codes, splits, sequences, metrics)
plans      end-to-end compositions and the query catalogue
streaming  incremental (micro-batch) execution of the series encoding
"""

__version__ = "0.1.0"
