"""strata: medallion-layer sales analytics on Spark DataFrames.

Layers: landing files -> raw (append-only, lineage columns) -> bronze (typed,
one row per business key) -> silver (enriched, day partitions) -> gold
(indicators, trailing means, completeness, alerts).  Every operator is a plain
function of DataFrames and Columns; Catalyst plans the work.
"""

__version__ = "0.1.0"
