"""Operators put together: models, the batch run, sample sets, test-data adapters."""
