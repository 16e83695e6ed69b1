"""Spark-native document retrieval, graph and verification analytics."""
