"""Streaming pickup of landed dates."""

from .complete import Released, released_dates, watch_complete
from .landing import changed_dates, watch_landing

__all__ = ["Released", "changed_dates", "released_dates", "watch_complete", "watch_landing"]
