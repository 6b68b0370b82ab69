"""Jobs and queries composed of operators."""
