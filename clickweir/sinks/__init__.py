"""Where results go: text, columnar files, sparse groups, existing tables, topics."""
