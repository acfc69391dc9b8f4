"""farelane: scheduled transit on road networks, computed with Spark DataFrames."""
