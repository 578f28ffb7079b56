"""DataFrame operators: keyed state, as-of joins, change capture, merge, quality."""
