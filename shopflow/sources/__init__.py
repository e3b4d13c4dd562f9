"""Reading and landing data: files, tables behind JDBC, high-water marks."""
