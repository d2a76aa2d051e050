"""A PySpark-native engine for life-science tables and large text corpora."""
