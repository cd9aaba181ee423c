"""The registered queries, the test tables dressed as call data, and the SQL to check against."""
