"""Input tables: declared schemas, readers, and the test-data derivation."""
