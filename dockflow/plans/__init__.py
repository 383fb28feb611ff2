"""The queries: each takes a prepared trips frame and returns a lazy DataFrame."""
