"""Change-data-capture synchronisation between two account systems, on Spark DataFrames."""
