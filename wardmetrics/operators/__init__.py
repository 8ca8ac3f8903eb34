"""DataFrame operators: filters, joins, reshapes, aggregates and checks."""
