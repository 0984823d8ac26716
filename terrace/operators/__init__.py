"""DataFrame to DataFrame operators of the warehouse."""
