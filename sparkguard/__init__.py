"""sparkguard: Spark-native transaction-fraud analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark
SQL expressions (or ``pyspark.ml`` stages at the model boundary).  Fits return
small parameter DataFrames that are joined back (broadcast, bounded size);
nothing is collected inside an operator.
"""

__version__ = "0.1.0"
