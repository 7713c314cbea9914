"""Models and jobs, each composed from operators."""
