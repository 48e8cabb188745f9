"""See the modules in this package."""
