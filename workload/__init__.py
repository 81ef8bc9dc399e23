"""The library's operators as queries over the star-schema tables, with SQL to check each."""
