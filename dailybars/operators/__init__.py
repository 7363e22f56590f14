"""DataFrame-to-DataFrame operators; nothing here writes."""
