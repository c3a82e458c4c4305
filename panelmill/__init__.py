"""Spark-native analytics over entity x period x measure panels."""
