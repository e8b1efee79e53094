"""Oracle SQL and the comparison tool."""
