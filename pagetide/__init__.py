"""Page-view stream analytics on Spark: decode, gate, roll up, report."""
