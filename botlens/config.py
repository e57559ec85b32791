"""Settings: frozen dataclasses, two presets, and one deep merge for overrides."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields

from botlens import values

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Weights:
    burst: float = 0.4
    error: float = 0.3
    user_agent: float = 0.3

    def __post_init__(self):
        if abs(self.burst + self.error + self.user_agent - 1.0) > 1e-9:
            raise ValueError("score weights must sum to 1")


@dataclass(frozen=True)
class Detection:
    burst_threshold: float = 10
    error_ratio_threshold: float = 0.5
    window_duration: str = "30 seconds"
    slide_duration: str = "10 seconds"
    burst_window: str = "1 minute"
    error_window: str = "5 minutes"
    watermark_delay: str = "10 minutes"
    bot_score_threshold: float = 0.5
    legacy_reasons: bool = False
    weights: Weights = field(default_factory=Weights)

    def __post_init__(self):
        if self.burst_threshold <= 0 or self.error_ratio_threshold <= 0:
            raise ValueError("thresholds must be positive")


@dataclass(frozen=True)
class UserAgents:
    bot_patterns: tuple[str, ...] = values.SUSPICIOUS_AGENTS
    whitelist: tuple[str, ...] = ()
    dash_is_empty: bool = False


@dataclass(frozen=True)
class Model:
    model_path: str | None = None
    prediction_threshold: float = 0.5
    window_duration: str = "60 seconds"
    slide_duration: str = "30 seconds"
    # "zero": arrival-time features are constant; "exact": they are computed, by streaming jobs too.
    temporal: str = "zero"

    def __post_init__(self):
        if self.temporal not in ("zero", "exact"):
            raise ValueError("temporal must be zero or exact")


@dataclass(frozen=True)
class Topic:
    bootstrap_servers: str = "localhost:9092"
    topic: str = "nginx-logs"
    starting_offsets: str = "earliest"
    # Off as in the original jobs: offsets that have expired are skipped with a warning in the log.
    fail_on_data_loss: bool = False


@dataclass(frozen=True)
class Stream:
    trigger_interval: str | None = None
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    compact_every: int | None = 500


@dataclass(frozen=True)
class Checkpoint:
    location: str | None = None


@dataclass(frozen=True)
class Settings:
    detection: Detection = field(default_factory=Detection)
    user_agent: UserAgents = field(default_factory=UserAgents)
    ml: Model = field(default_factory=Model)
    kafka: Topic = field(default_factory=Topic)
    streaming: Stream = field(default_factory=Stream)
    checkpoint: Checkpoint = field(default_factory=Checkpoint)

    def override(self, changes: Mapping) -> "Settings":
        """New settings with ``changes`` (a nested mapping) merged in at every depth."""
        return _build(Settings, deep_merge(asdict(self), _lift_spark_section(changes)))


def deep_merge(base: Mapping, changes: Mapping) -> dict:
    merged = dict(base)
    for key, value in changes.items():
        old = merged.get(key)
        both = isinstance(old, Mapping) and isinstance(value, Mapping)
        merged[key] = deep_merge(old, value) if both else value
    return merged


def _lift_spark_section(changes: Mapping) -> dict:
    # A `spark:` section may carry the streaming and checkpoint settings.
    changes = dict(changes)
    spark = changes.pop("spark", None) or {}
    if "streaming" in spark:
        changes["streaming"] = deep_merge(spark["streaming"], changes.get("streaming", {}))
    if "checkpoint_location" in spark:
        changes.setdefault("checkpoint", {"location": spark["checkpoint_location"]})
    return changes


def _build(cls, data: Mapping):
    names = {f.name for f in fields(cls)}
    unknown = sorted(str(name) for name in data if name not in names)
    if unknown and cls is Settings:  # sections of other programs may share the file
        log.warning("settings sections that are not used: %s", ", ".join(unknown))
    elif unknown:
        raise ValueError(f"unknown settings in {cls.__name__}: {', '.join(unknown)}")
    known = {}
    for f in fields(cls):
        if f.name not in data:
            continue
        value = data[f.name]
        nested = _SECTIONS.get((cls, f.name))
        if nested is not None:
            value = _build(nested, value or {})
        elif isinstance(value, list):
            value = tuple(value)
        known[f.name] = value
    return cls(**known)


_SECTIONS = {
    (Settings, "detection"): Detection,
    (Settings, "user_agent"): UserAgents,
    (Settings, "ml"): Model,
    (Settings, "kafka"): Topic,
    (Settings, "streaming"): Stream,
    (Settings, "checkpoint"): Checkpoint,
    (Detection, "weights"): Weights,
}

# Low thresholds and short windows: reacts fast, flags more.
SENSITIVE = Settings()

# Production thresholds over one-minute windows, known crawlers exempt.
STANDARD = Settings(
    detection=Detection(
        burst_threshold=100,
        window_duration="1 minute",
        slide_duration="30 seconds",
        bot_score_threshold=0.7,
    ),
    user_agent=UserAgents(
        bot_patterns=values.SUSPICIOUS_AGENTS_EXTENDED,
        whitelist=values.WELCOME_AGENTS,
    ),
    streaming=Stream(trigger_interval="60 seconds"),
)

PRESETS = {"sensitive": SENSITIVE, "standard": STANDARD}


def load_settings(path: str | None = None, preset: Settings = SENSITIVE) -> Settings:
    """Read a YAML or JSON settings file over a preset; no path returns the preset."""
    if path is None:
        return preset
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        changes = json.loads(text)
    else:
        import yaml

        changes = yaml.safe_load(text)
    return preset.override(changes or {})
