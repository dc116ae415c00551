"""A PySpark-native engine for key-value change feeds."""
