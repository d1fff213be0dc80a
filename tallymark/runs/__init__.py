"""Runs: publishing under a run key, reports over runs, monitoring."""
