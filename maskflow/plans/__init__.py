"""Whole jobs: pipelines compiled from a specification, and the batch jobs."""
