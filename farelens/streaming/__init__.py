"""Reports kept up to date from files as they arrive."""
