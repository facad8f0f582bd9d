"""quantlake — Spark-native toolkit for financial research tables.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
is built from Spark's own DataFrame/SQL expressions, so Catalyst can push
filters and prune columns, and the work is partitioned by Spark.
"""

__version__ = "0.1.0"
