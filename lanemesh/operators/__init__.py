"""DataFrame operators: linear referencing, chains, overlaps, partitioning, numbering, grouping."""
