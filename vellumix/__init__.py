"""Spark-native text-corpus analytics: DataFrame in, DataFrame out."""
