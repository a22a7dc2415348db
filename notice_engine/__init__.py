"""A PySpark-native engine for public-notice and document analytics."""
