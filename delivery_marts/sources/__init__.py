"""Reading feeds, tables and databases."""
