"""Query catalogue and pipelines."""
