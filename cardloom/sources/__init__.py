"""Where pages come from and where records go."""
