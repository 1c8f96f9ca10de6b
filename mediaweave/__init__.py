"""A PySpark-native engine for time-based media data."""
