"""Settings of a following run from a TOML file: strict names, checked ranges, overrides."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields

from .sources.techlog import Options

RANGES = {
    "poll_ms": (1, 3_600_000), "idle_close_ms": Options.RANGES["idle_ms"], "batch_bytes": Options.RANGES["max_bytes_per_trigger"],
    "retain_days": (1, 36_500), "retain_rollup_days": (1, 36_500), "drain_attempts": (1, 1000),
}


@dataclass(frozen=True)
class Settings:
    """``inputs``, ``target`` and ``state_dir`` are required; the rest has defaults."""

    inputs: tuple[str, ...]
    target: str
    state_dir: str
    poll_ms: int = 500
    idle_close_ms: int = 2000
    batch_bytes: int = 256 << 20
    sql_norm: bool = True
    retain_days: int = 90
    retain_rollup_days: int = 400
    drain_attempts: int = 3
    stats_json: str = ""

    @classmethod
    def of(cls, given: dict) -> Settings:
        """Checked settings; an unknown name, a wrong type, a number out of its range or a missing name is a ValueError."""
        own = {f.name: f for f in fields(cls)}
        unknown = sorted(set(given) - set(own))
        missing = sorted(n for n in ("inputs", "target", "state_dir") if not given.get(n))
        if unknown or missing:
            raise ValueError(f"unknown settings {unknown}, missing settings {missing}")
        for name, value in given.items():
            kind = {"int": int, "bool": bool, "str": str}.get(own[name].type)
            if kind and type(value) is not kind:
                raise ValueError(f"{name} must be of type {own[name].type}")
            low, high = RANGES.get(name, (None, None))
            if low is not None and not low <= value <= high:
                raise ValueError(f"{name} must be between {low} and {high}")
        if isinstance(given["inputs"], str) or not all(isinstance(x, str) and x for x in given["inputs"]):
            raise ValueError("inputs must be a list of paths")
        return cls(**{**given, "inputs": tuple(given["inputs"])})

    @classmethod
    def read(cls, path: str, **overrides) -> Settings:
        """A file's settings; overrides that are not None go before them."""
        with open(path, "rb") as f:
            return cls.of(tomllib.load(f) | {k: v for k, v in overrides.items() if v is not None})

    def follow_arguments(self) -> dict:
        """Arguments of ``streaming.follow.follow``."""
        return {
            "path": ",".join(self.inputs), "target": self.target, "checkpoint": self.state_dir, "interval": f"{self.poll_ms} milliseconds",
            "fingerprints": self.sql_norm, "idle_ms": self.idle_close_ms, "max_bytes_per_trigger": self.batch_bytes,
        }
