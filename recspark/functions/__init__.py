"""Column builders: reproducible draws, array maths, responses."""
