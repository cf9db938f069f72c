"""Complete runs from files to files."""
