"""Named queries over the supplied tables and their check SQL."""
