"""Every tunable of the platform in one immutable value, passed explicitly to the jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    # Last instant owned by the history load. The live log owns everything after it, and the model
    # may learn from nothing after it.
    cutoff: datetime = datetime(2025, 12, 31, 23, 59, 59)
    live_era_start: date = date(2026, 1, 1)
    source: str = "tlc_yellow"

    # Event-time windows.
    window_minutes: int = 5
    grace_minutes: int = 10
    liveness_seconds: int = 2

    # Training.
    min_price: Decimal = Decimal("2.50")
    max_price: Decimal = Decimal("250.00")
    train_sample_rows: int = 1_500_000
    holdout_percent: int = 20
    seed: int = 42
    encoding_folds: int = 5
    boosting_rounds: int = 300
    boosting_patience: int = 20
    learning_rate: float = 0.1

    # Anomaly rules.
    mae_critical: float = 2.0
    mae_serious: float = 1.5
    r2_serious: float = 0.30
    divergence_warning: float = 0.05
    idle_after: timedelta = timedelta(minutes=5)

    # Read limits of the serving queries (each one is the feature: a top-k or a newest-n report).
    top_zones: int = 10
    newest_windows: int = 96
    newest_quotes: int = 300

    @property
    def window(self) -> str:
        return f"{self.window_minutes} minutes"

    @property
    def grace(self) -> str:
        return f"{self.grace_minutes} minutes"
