"""Table schemas, readers, writers and inventories."""
