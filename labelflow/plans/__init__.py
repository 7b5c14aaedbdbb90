"""End-to-end jobs over the operators."""
