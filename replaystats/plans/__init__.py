"""The pipeline's jobs, composed of the operators."""
