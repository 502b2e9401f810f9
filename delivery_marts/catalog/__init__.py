"""Every operator as a named query on the given tables, with SQL to compare it with."""
