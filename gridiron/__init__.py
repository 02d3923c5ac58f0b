"""Football analytics on Spark: landing, staging, marts, queries and checks."""
