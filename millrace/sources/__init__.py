"""Topics, file directories and keyed tables."""
