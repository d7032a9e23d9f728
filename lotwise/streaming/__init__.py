"""The row-local pipelines over landing folders."""
