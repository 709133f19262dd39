"""Table-to-table operators: which row wins, changes, joins, aggregates."""
