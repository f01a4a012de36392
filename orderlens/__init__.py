"""Spark-native order and customer-experience analytics."""
