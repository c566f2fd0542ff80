"""The library on the given tables: a feed derived from them, the queries, and the SQL to check them."""
