"""Sources: report / entity files, listing files, tables, object-path metadata."""
