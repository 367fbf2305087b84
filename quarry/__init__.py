"""quarry: Spark-native operators for machine-learning data preparation.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects and
stays in column expressions (or Arrow batches where no expression exists), so
Catalyst can prune, push down and fuse the work.
"""

__version__ = "0.1.0"
