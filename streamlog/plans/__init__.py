"""The registered queries with the SQL that each must agree with."""
