"""State between runs: pure transitions on tables, and versioned snapshots that hold them."""
