"""Customer feature engineering for churn analysis, written for Spark.

Five layers, each a set of plain ``DataFrame -> DataFrame`` functions:

* ``sources``    declared table schemas, CSV loading, versioned parquet output
* ``operators``  integrity checks, cleaning steps, keep-latest, order sequence
* ``functions``  column helpers (exact ratios, buckets, histogram bins)
* ``plans``      the customer features, the reports on them, the whole build
"""
