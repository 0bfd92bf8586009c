"""DataFrame-to-DataFrame operators; none of them reads the clock or the file system."""
