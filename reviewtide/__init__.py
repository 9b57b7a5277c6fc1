"""Review analytics on Spark: repair, enrich, join and publish place reviews."""
