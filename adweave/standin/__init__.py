"""Queries over stand-in tables, each with the SQL that checks it."""


def load() -> None:
    """Register every query."""
    from adweave.standin import basics, jobs, joins, payloads, upserts  # noqa: F401
