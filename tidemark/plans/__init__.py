"""Composed jobs: adapters over the sample tables, the research chain and the query registry."""
