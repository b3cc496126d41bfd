"""Named queries over the given tables, and SQL that another engine runs to check them."""
