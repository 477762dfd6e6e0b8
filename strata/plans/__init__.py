"""Named models of the medallion layers, each a function of DataFrames."""
