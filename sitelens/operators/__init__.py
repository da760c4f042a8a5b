"""DataFrame -> DataFrame operators (joins, ranking, aggregates, upsert, checks)."""
