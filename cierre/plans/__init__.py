"""Reusable plan fragments: closed rows, enrichment joins, period tagging,
scaffolds and country totals."""
