"""Where data comes from: log stores, table scans, the data source, JDBC."""
