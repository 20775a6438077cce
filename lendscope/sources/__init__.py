"""Finding and reading raw loan files."""
