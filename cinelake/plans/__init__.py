"""Named business queries and the batch load."""
