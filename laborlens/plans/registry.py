"""Imports every query module so their ``@register`` calls run."""
from __future__ import annotations

from . import catalog
from . import q_clean  # noqa: F401
from . import q_stats  # noqa: F401
from . import q_tests  # noqa: F401
from . import q_more  # noqa: F401
from . import q_models  # noqa: F401
from . import q_advisor  # noqa: F401
from . import q_io  # noqa: F401


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLES)
