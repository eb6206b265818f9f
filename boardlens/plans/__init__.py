"""Stage tables, model preparation, comparison and the query catalogue."""
