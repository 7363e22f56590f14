"""Where bars come from and where tables are kept."""
