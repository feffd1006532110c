"""The registered queries over the driver's tables; importing a module registers what it holds."""

from . import analytics, changes, cleaning, dimensions, extraction, facts, peers, quality, resolve, schedules_read, textual  # noqa: F401
from .binding import oracle_sql, queries  # noqa: F401
