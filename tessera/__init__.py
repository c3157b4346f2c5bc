"""Spark-native engine for producing, judging and analysing model-generated records."""
