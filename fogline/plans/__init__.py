"""Domain pipelines built from the operators: clean tables, marts, metrics."""
