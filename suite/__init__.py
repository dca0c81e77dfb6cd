"""Registered queries: the library's operators over the given tables, with SQL to check them.

Importing the modules fills the registry in order.
"""

from suite import (  # noqa: F401
    audit,
    catalog,
    cleaning,
    incremental,
    layouts,
    models,
    profiles,
    schemas,
    shaping,
    sources,
    star,
)
from suite.registry import ORACLE, QUERIES  # noqa: F401
