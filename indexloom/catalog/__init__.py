"""The operators run on the supplied star schema, and the plain SQL they are checked against."""
