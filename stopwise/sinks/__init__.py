"""Table writes, temporary views and previews."""
