"""Whole runs: a page catalogue run and a vendor feed run."""
