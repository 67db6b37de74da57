"""The layer builders and the queries served from Gold."""
