"""Table declarations, CSV loading and versioned output."""
