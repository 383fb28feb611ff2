"""Where trips come from and where results go."""
