"""Spark-native building blocks for collaborative-filtering recommenders."""
