"""A Spark-native engine for incremental archive analytics."""
