"""Where results go: streams, tables, documents."""
