"""Optional: landing new files as they arrive."""
