"""Delivery-fleet event analytics on Spark: streams, tables, reports and alerts."""
