"""Plans over the operators."""
