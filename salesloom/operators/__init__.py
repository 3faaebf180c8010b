"""DataFrame operators: shaping, keys, staging and type-2 history."""
