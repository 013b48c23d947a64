"""Sinks: result tables keyed by run id, full refreshes, person-clustered exports."""
