"""A Spark-native engine for service accessibility analytics."""
