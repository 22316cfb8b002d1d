"""Change data capture and lakehouse refinement on Spark DataFrames."""
