"""Composed pipelines and the queries registered for the driver."""
