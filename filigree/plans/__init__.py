"""Ready jobs made of the operators."""
