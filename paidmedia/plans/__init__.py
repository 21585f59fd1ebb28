"""Named queries over the raw tables and the SQL they are checked against."""
