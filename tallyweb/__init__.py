"""tallyweb: web-contact analytics on Spark DataFrames."""
