"""A PySpark-native engine for monitoring publications and similar text corpora."""
