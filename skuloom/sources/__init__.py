"""Reading and writing of documents, tables, control tables and relational targets."""
