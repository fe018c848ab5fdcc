"""Thresholds and retention rules, as one typed object each."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QualityParams:
    # The published defaults of the quality checks.
    max_null_rate: float = 0.05
    min_row_count: int = 10
    anomaly_zscore: float = 3.0
    lookback_runs: int = 7
    history_runs: int = 30
    anomaly_min_points: int = 3
    max_age_hours: int = 26


@dataclass(frozen=True)
class RetentionRule:
    """Age in days at which a partition leaves each storage tier; ``None`` keeps it for good."""

    infrequent_days: int
    archive_days: int
    expire_days: int | None = None


QUALITY = QualityParams()

#: Least rows of a run where a day has fewer than ``min_row_count``: one document, rate or summary.
LEAST_ROWS = {"raw/weather": 1, "raw/crypto": 1, "cleaned/crypto": 1, "curated/daily_summary": 1}

# The published lifecycle of the layers.
RETENTION = {
    "raw": RetentionRule(infrequent_days=30, archive_days=90, expire_days=365),
    "cleaned": RetentionRule(infrequent_days=60, archive_days=180),
}

OUTPUT_VERSION = "1.0.0"
