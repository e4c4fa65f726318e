"""paperlake: a PySpark-native engine for scholarly-article corpora."""
