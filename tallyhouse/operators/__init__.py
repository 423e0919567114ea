"""DataFrame operators that several tables or reports share."""
