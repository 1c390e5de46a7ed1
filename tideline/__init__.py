"""Point-in-time market-data tables on Spark: normalise, merge, read as of a date, audit, publish."""
