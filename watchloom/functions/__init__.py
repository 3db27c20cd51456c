"""Part of watchloom; see the package docstring."""
