"""Writing tables by their layout columns, and reading them back."""
