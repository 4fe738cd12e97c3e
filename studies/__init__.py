"""Studies derived from the benchmark tables, and the SQL that checks them."""
