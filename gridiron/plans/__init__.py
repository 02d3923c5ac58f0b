"""User-level queries, data checks and the pipeline run."""
