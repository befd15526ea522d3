"""Reusable plan fragments: lineage cuts, bucketed joins, tiles, fix-points."""
