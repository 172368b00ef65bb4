"""One settings object for every tunable (finding D11: no hard-coded delays)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's for right results.
# Expected channel mix used by the drift metric, in this order:
# organic 0.28, paid_search 0.24, social 0.16, email 0.14, affiliate 0.10, direct 0.08.
EXPECTED_CHANNEL_MIX: dict[str, float] = {
    "organic": 0.28,
    "paid_search": 0.24,
    "social": 0.16,
    "email": 0.14,
    "affiliate": 0.10,
    "direct": 0.08,
}


@dataclass(frozen=True)
class Settings:
    watermark_delay: str = "20 minutes"
    join_lookback_minutes: int = 45
    # Width of the time buckets that widen the interval join's equi-keys.
    # Orders are copied into ceil(lookback / width) + 1 buckets; narrower
    # buckets split a hot session over more tasks.
    join_bucket_minutes: int = 45
    # Sessions with more clicks than this get buckets of their own width (0: no session does). Finding them
    # is one more pass over the clicks' keys; at most clicks / join_hot_clicks of them are broadcast.
    join_hot_clicks: int = 0
    join_hot_bucket_minutes: int = 1
    trigger_interval: str = "5 seconds"
    kpi_window: str = "1 minute"
    campaign_window: str = "5 minutes"
    campaign_slide: str = "1 minute"
    quality_window: str = "5 minutes"
    quality_slide: str = "1 minute"
    drift_window: str = "10 minutes"
    drift_slide: str = "2 minutes"
    null_ratio_threshold: float = 0.02
    duplicate_ratio_threshold: float = 0.005
    unknown_event_type_threshold: float = 0.001
    # Streams: remember every id (exact, state grows with the ids) instead of those within the watermark delay.
    dedupe_forever: bool = False
    # Gold partition granularity of the live path: each micro-batch recomputes
    # and replaces only the slots its rows touch.
    gold_slot_minutes: int = 10
    # Files that one trigger writes to one partition of a bronze table, at most.
    sink_salt: int = 4
    # State store of the stateful streams (C6). RocksDB keeps join/dedupe
    # state off the JVM heap and checkpoints incrementally.
    state_store_provider: str = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    max_offsets_per_trigger: int = 60000
    # False skips offsets that have expired on the broker without failing: their records are lost to the pipeline.
    # The value is the reference's; set True where a gap must stop the job.
    fail_on_data_loss: bool = False
    starting_offsets: str = "latest"
    # Relative error of HLL distinct counts on streams (Spark and the reference
    # default). Sketch state grows as 1 / rsd^2: 0.01 would be ~32x larger.
    approx_rsd: float = 0.05
    expected_channel_mix: dict[str, float] = field(
        default_factory=lambda: dict(EXPECTED_CHANNEL_MIX)
    )

    @property
    def longest_window_minutes(self) -> int:
        """The longest gold window; a row touches windows that start at most this long before it."""
        return max(minutes(w) for w in (self.kpi_window, self.campaign_window, self.quality_window, self.drift_window))


def minutes(interval: str) -> int:
    """``"20 minutes"`` -> 20; whole minutes, hours or days."""
    n, unit = interval.split()
    return int(n) * {"minute": 1, "hour": 60, "day": 1440}[unit.rstrip("s")]


DEFAULT_SETTINGS = Settings()
