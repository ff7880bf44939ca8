"""Reports and whole flows built from the operators."""
