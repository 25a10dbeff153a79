"""Day folders and pages arriving over time, as micro-batches."""
