"""DataFrame-to-DataFrame operators; column names are arguments, nothing is tied to one table."""
