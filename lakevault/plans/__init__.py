"""Composed work: loading pipelines, dimensional views, reports and the named query registry."""
