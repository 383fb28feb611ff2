"""The same answers in plain SQL, for checking."""
