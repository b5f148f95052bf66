"""DataFrame operators of the library, one module per area."""
