"""Spark-native analytics for polled, irregular feeds: temporal operators, star schema, measures, table store."""
