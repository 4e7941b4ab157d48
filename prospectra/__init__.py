"""A Spark-native lead-intelligence engine."""
