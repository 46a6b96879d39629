"""kilnspark: a PySpark-native engine for building, auditing and scoring text corpora."""
