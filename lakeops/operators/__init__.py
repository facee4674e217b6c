"""DataFrame -> DataFrame operators: cleaning, quality, joins, ordering, table changes, layout."""
