"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage.  ``queries()`` and
``oracle_sql()`` are the registrations that ``__spark_entry__.py`` picks up.
"""

from __future__ import annotations


def queries() -> dict:
    from . import registry

    return registry.queries()


def oracle_sql() -> dict:
    from . import registry

    return registry.oracle_sql()
