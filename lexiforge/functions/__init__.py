"""Part of lexiforge."""
