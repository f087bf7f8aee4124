"""DataFrame operators; each takes and returns DataFrames and leaves strategy to Catalyst."""
