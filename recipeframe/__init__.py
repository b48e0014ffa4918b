"""PySpark-native engine that turns raw recipe corpora into a clean, deduplicated, evidence-scored data set."""
