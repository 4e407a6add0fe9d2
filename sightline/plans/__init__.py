"""The three jobs as bounded (batch) plans."""
