"""ordermart: order analytics on Spark (star schema, checks and measures)."""
