"""Reading, writing and staging."""
