"""Schema-level column choices (driver-side lists, no data)."""

from __future__ import annotations

from collections.abc import Sequence

from ..constants import CHANNEL_TOKENS, DERIVED_TOKENS, FEATURE_CHANNELS


def detect_channels(columns: Sequence[str]) -> list[str]:
    """Raw channel columns by name: contains Appliance/Aggregate and none
    of the derived-feature tokens."""
    return [c for c in columns if any(t in c for t in CHANNEL_TOKENS)
            and not any(t in c for t in DERIVED_TOKENS)]


def choose_target(channels: Sequence[str]) -> str:
    """Aggregate if present, else the first channel."""
    if not channels:
        raise ValueError("no channel columns")
    return "Aggregate" if "Aggregate" in channels else channels[0]


def feature_channels(channels: Sequence[str], n: int = FEATURE_CHANNELS) -> list[str]:
    """The first ``n`` channels (in column order, D3)."""
    return list(channels[:n])
