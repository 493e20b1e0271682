"""The library bound to the test tables, with the SQL each result must equal."""
