"""Spark-native analytics over collections of report pages and the tables on them."""
