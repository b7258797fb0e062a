"""plumbline: a PySpark-native analytics engine for website-monitoring data."""
