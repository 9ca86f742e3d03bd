"""murmura: a PySpark-native engine for aspect-level opinion analytics."""
