"""DataFrame-to-DataFrame operators with column names as arguments."""
