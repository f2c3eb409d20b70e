"""The registered queries, their inputs and the SQL that states the expected results."""
