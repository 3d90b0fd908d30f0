"""Readers: CSV source tables, message text, enriched JSON lines, warehouse tables."""
