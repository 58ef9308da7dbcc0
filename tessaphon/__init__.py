"""tessaphon: a Spark-native engine for labelled audio feature datasets."""
