"""Parameters of the operators, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Domains:
    """Canonical spellings of the categorical columns (fixed values)."""

    regions: tuple[str, ...] = ("North", "South", "East", "West", "International")
    channels: tuple[str, ...] = ("Direct", "Partner", "Online")
    segments: tuple[str, ...] = ("Enterprise", "SMB", "Consumer")
    categories: tuple[str, ...] = ("Electronics", "Software", "Services", "Hardware")


@dataclass(frozen=True)
class AnomalySettings:
    zscore_threshold: float = 2.5
    iqr_multiplier: float = 1.5
    columns: tuple[str, ...] = ("revenue", "cost")
    iqr_column: str = "discount_pct"


@dataclass(frozen=True)
class Settings:
    domains: Domains = field(default_factory=Domains)
    anomaly: AnomalySettings = field(default_factory=AnomalySettings)
    dedup: str = "keep_first"  # or "drop_all"
    source_system: str = "CSV_LOAD"
    date_formats: tuple[str, ...] = ()  # tried in order where a date is not in ISO form
