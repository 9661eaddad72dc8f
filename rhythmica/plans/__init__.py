"""Named queries over the test tables, each with the SQL that states its result."""
