"""Column functions: times, dynamic JSON values, identifiers."""
