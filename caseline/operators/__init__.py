"""DataFrame operators: repair, typing, collapse, joins, rules, profiles."""
