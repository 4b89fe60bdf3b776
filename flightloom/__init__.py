"""Flight-event analysis tables as Spark DataFrames."""
