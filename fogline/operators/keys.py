"""The canonical transit key and the order in which key columns are compared."""

from __future__ import annotations

from collections.abc import Sequence

# The six columns that identify a transit row.
CANONICAL_KEY = (
    "agency_id",
    "trip_id",
    "trip_start_date",
    "trip_start_time",
    "direction_id",
    "stop_sequence",
)

_SELECTIVE = ("trip_id", "stop_sequence", "trip_start_date")


def selective_first(keys: Sequence[str]) -> list[str]:
    """Same keys, the ones with many values first.

    Sorts compare a binary prefix of their first column before anything else; leading with
    an agency of two values would send every comparison through all the columns.
    """
    return sorted(keys, key=lambda k: _SELECTIVE.index(k) if k in _SELECTIVE else len(_SELECTIVE))
