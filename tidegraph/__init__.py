"""A Spark-native engine for follow graphs built from signed, replaceable events."""
