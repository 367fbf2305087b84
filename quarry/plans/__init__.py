"""Composed jobs (``pipelines``) and the registered stand-in queries (``queries``)."""
