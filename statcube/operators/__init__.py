"""DataFrame operators: filters, series, joins, aggregates, search, trees, archives."""
