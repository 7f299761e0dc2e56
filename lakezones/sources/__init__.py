"""Sources: landed pages, delimited extracts and tables."""
