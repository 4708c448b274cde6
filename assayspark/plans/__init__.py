"""Reports and workflows built from the operators."""
