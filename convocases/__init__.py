"""Support-conversation analytics on Spark: clean, order, segment, classify, report."""
