"""Reading the request log and the signage table; running SQL text."""
