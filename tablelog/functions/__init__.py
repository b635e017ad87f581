"""Pure helpers: schema rules, table properties, intervals and time strings."""
