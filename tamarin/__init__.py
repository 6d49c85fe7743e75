"""tamarin: Spark-native operators for low-resource speech and text corpora."""
