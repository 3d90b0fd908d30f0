"""Writers: text, CSV, the partitioned warehouse table, views and model tables."""
