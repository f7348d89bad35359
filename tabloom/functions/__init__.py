"""Column helpers, wide aggregates, exact quantiles and lineage cutting."""
