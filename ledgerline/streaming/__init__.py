"""The contract applied to files as they arrive."""
