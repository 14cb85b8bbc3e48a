"""Spark-native analytics for collections of imaging studies."""
