"""DataFrame operators: chunking, selection, roles, incremental processing, records, pages."""
