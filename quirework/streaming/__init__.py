"""Incremental (available-now) runs of the enrichment step."""
