"""Sources: CSV, XML, JDBC and object stores, read as rows of text."""
