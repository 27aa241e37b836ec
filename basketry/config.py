"""Settings shared by the batch and streaming jobs."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace

# Topic names and the table topics of the change feed.
TOPICS = {
    "orders": "orders",
    "payments": "payments",
    "clicks": "clicks",
    "users": "users",
    "inventory": "inventory_updates",
}
CDC_PREFIX = "ecommerce_cdc.ecommerce_cdc"
CDC_TABLES = ("customers", "products", "orders", "inventory_log")


@dataclass(frozen=True)
class Settings:
    lake_mode: str = "local"
    lake_root: str = "/data/lake"
    kafka_servers: str = "localhost:9092"
    kafka_min_partitions: int | None = None
    #: Most records, or new files, that one micro-batch takes; none: all that is there.
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    topics: dict = field(default_factory=lambda: dict(TOPICS))
    window: str = "1 minute"
    watermark: str = "10 minutes"
    trigger: str = "30 seconds"
    session_gap: str = "30 minutes"
    state_partitions: int | None = None
    kpi_source: str = "bronze"
    #: Events timed later than this after their arrival are dead letters.
    max_ahead_minutes: int = 60
    dedup_metrics: bool = True
    #: Batches after which a metric table is folded into days, and seconds that readers may take.
    fold_every: int = 64
    fold_grace_seconds: int = 600
    object_store_endpoint: str | None = None

    @classmethod
    def from_env(cls, prefix: str = "BASKETRY_") -> "Settings":
        """Defaults overridden by string variables such as BASKETRY_WATERMARK."""
        found = {}
        for f in fields(cls):
            raw = os.environ.get(prefix + f.name.upper())
            if raw is not None and f.name != "topics":
                if f.type.startswith("int"):
                    found[f.name] = int(raw)
                elif f.type == "bool":
                    found[f.name] = raw.strip().lower() in ("1", "true", "yes")
                else:
                    found[f.name] = raw
        return replace(cls(), **found)

    def path(self, *parts: str) -> str:
        """Path below the lake root: `file://` in local mode, else `s3a://`."""
        root = self.lake_root.rstrip("/")
        if "://" not in root:
            root = f"file://{root}" if self.lake_mode == "local" else f"s3a://{root.lstrip('/')}"
        return "/".join([root, *[p.strip("/") for p in parts]])

    def bronze(self, topic: str) -> str:
        return self.path("bronze", topic)

    def silver(self, name: str) -> str:
        return self.path("silver", name)

    def gold(self, name: str) -> str:
        return self.path("gold", name)

    def dead_letters(self, topic: str) -> str:
        return self.path("dead_letters", topic)

    def metric(self, name: str) -> str:
        return self.path("metrics", name)

    def checkpoint(self, name: str) -> str:
        return self.path("checkpoints", name)

    def cdc_topics(self) -> list[str]:
        return [f"{CDC_PREFIX}.{t}" for t in CDC_TABLES]
