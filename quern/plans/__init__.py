"""Registered queries; importing this package fills ``REGISTRY``."""

from quern.plans.registry import REGISTRY, Query, register  # noqa: F401
from quern.plans import (  # noqa: F401,E402
    aggregates,
    io_udf,
    joins,
    relational,
    scalar_functions,
    streaming,
    windows_batch,
)


def load_all() -> dict[str, Query]:
    return REGISTRY
