"""DataFrame operators: counts, running totals, offsets, upserts."""
