"""Registered queries over the driver's tables (see ``registry``)."""

from . import metric_queries  # noqa: F401  (registers on import)
from .registry import QUERIES, SQL  # noqa: F401
from . import pairing_queries  # noqa: F401,E402
from . import grid_queries  # noqa: F401,E402
from . import region_queries, reduction_queries  # noqa: F401,E402
from . import series_queries, plot_queries  # noqa: F401,E402
from . import source_queries  # noqa: F401,E402
