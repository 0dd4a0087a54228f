"""Plans: table builders, named analytical queries, views, marts and the staged run."""
