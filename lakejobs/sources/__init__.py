"""Readers: files, JDBC tables and topics."""
