"""PySpark-native engine for building training corpora."""
