"""Files, tables and exports."""
