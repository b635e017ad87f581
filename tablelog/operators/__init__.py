"""What changes a table: transactions, writes, checkpoints, the catalog."""
