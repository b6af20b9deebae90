"""strataspark: a PySpark-native engine for multi-temporal terrain layers."""
