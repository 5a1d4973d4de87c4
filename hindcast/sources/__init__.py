"""Sources: publication files, listings, made-up scenarios."""
