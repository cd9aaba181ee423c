"""Reading sources, incremental and full loads, and publishing tables."""
