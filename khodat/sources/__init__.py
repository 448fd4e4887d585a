"""Readers: files, lakehouse layers, JDBC and HTML pages."""
