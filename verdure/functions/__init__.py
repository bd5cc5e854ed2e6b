"""Column helpers and the SQL function surface."""
