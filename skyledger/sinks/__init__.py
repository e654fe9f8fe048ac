"""Writers of published tables."""
