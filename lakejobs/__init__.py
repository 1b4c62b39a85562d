"""lakejobs: batch and streaming analytics jobs on Spark DataFrames."""
