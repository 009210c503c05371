"""Job settings and their command-line form."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, fields

JOBS = (
    "catalogue",
    "commerce",
    "listings",
    "publish-orders",
    "publish-prices",
    "category-stream",
    "item-stream",
    "community-stream",
    "item-window-stream",
    "genre-stream",
)


@dataclass(frozen=True)
class JobConfig:
    job: str = "commerce"
    input: str = "input"
    output: str | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_driver: str | None = None
    shuffle_partitions: int | None = None
    write_partitions: int | None = None
    top_n: int = 10
    min_support: float = 0.005
    min_confidence: float = 0.10
    batch_id: int = 1
    district: str | None = None
    current_time: bool = False
    kafka_bootstrap: str | None = None
    topic: str | None = None
    checkpoint: str | None = None
    window_duration: str = "1 minute"
    slide_duration: str = "30 seconds"
    trigger_seconds: int = 10
    max_offsets: int | None = None
    max_files: int | None = None
    tolerate_data_loss: bool = False
    output_mode: str = "update"
    time_zone: str = "Asia/Shanghai"
    drain: bool = False
    dry_run: bool = False
    log_level: str = "WARN"

    def __post_init__(self) -> None:
        for name in ("write_partitions", "shuffle_partitions", "top_n", "trigger_seconds", "max_offsets", "max_files"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("min_support", "min_confidence"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                raise ValueError(f"{name} must be between 0 and 1")
        if self.output_mode not in ("update", "complete", "append"):
            raise ValueError("output_mode must be update, complete or append")


def parse(arguments: Sequence[str]) -> JobConfig:
    parser = argparse.ArgumentParser(prog="quaymark", description="Run one analysis job.")
    parser.add_argument("job", choices=JOBS)
    for item in fields(JobConfig):
        if item.name == "job":
            continue
        flag = "--" + item.name.replace("_", "-")
        if item.type == "bool":
            parser.add_argument(flag, action="store_true")
        else:
            kind = int if "int" in item.type else float if "float" in item.type else str
            parser.add_argument(flag, type=kind, default=item.default)
    return JobConfig(**vars(parser.parse_args(arguments)))
