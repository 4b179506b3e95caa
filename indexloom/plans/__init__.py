"""The three stages of the index, each from tables to tables."""
