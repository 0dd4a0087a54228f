"""DataFrame operators: keys, lookups, filters, ranking, documents, quality checks."""
