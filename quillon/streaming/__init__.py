"""Documents that keep arriving."""
