"""waymark: curation of large point-of-interest datasets on Spark DataFrames."""
