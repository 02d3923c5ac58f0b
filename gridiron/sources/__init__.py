"""Reading landed files and writing databases, tables and views."""
