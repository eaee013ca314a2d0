"""DataFrame operators of the three pipeline steps, publishing and checks."""

from followrec.operators import closest, quality, recommend, reputation, tables  # noqa: F401
