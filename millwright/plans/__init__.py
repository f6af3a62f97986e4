"""Jobs, the fixture views and the registered queries with their check SQL."""
