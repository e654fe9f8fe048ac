"""The published tables as DataFrame plans."""
