"""The registered queries, the flight data they derive from the given tables, and the SQL that checks them."""
