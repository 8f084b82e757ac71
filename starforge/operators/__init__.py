"""DataFrame operators of the file-to-cube pipeline."""
