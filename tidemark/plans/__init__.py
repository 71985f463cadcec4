"""Composite jobs (the reference's end-to-end flows) and the query registry."""
