"""Whole runs, composed from the operators; together with the store the only code that writes."""
