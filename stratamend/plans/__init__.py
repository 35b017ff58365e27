"""State, versioned tables, tenants, loads, and the query catalogue."""
