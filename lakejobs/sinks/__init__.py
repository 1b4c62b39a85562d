"""Writers: files, JDBC tables, topics and batch-keyed folders."""
