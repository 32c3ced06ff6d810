"""Spark-native extraction and normalisation of message traffic."""
