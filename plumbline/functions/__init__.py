"""Column-level helpers: repeatable draws, cleaning, naming."""
