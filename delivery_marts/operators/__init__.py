"""DataFrame-to-DataFrame operators: normalisation, joins, keys, constraints, checks."""
