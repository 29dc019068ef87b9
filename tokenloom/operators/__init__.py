"""Relational operators: joins, aggregations, prefix sums, packing, blending."""
