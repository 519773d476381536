"""Jobs, and the queries over the test tables."""
