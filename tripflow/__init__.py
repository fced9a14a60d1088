"""Trip analytics on Spark: feeds, cleaning, zone joins, reports, streams and fare models."""
