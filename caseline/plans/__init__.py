"""Table declarations and the jobs built from them."""
