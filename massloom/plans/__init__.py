"""Jobs, each a function from DataFrames to DataFrames."""
