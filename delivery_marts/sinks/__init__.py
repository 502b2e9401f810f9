"""Writing tables and marts."""
