"""DataFrame operators: as-of selection, normalisation, metrics, gates."""
