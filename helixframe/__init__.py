"""A Spark-native engine for curating and featurising biomolecular structure data."""
