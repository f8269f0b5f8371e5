"""Named pipelines built from the operators."""
