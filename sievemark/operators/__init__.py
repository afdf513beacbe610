"""DataFrame operators: every helper takes and returns DataFrames."""
