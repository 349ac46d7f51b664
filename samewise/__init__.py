"""samewise: a PySpark-native entity-resolution and record-linkage engine."""
