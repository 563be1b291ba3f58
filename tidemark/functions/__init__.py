"""Column-level helpers: time truncation and differences, statistics tails, formatting."""
