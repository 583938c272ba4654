"""flowguard — Spark-native flow analytics and class-imbalance toolkit.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, aggregates, windows and MLlib.  See README.md for the map from
operators to modules.
"""

__version__ = "0.1.0"
