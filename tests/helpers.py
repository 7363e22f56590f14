"""Helpers that tests import by name (several folders have a conftest)."""


def as_set(frame):
    return {tuple(row) for row in frame.collect()}
