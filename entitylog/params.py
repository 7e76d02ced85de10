"""Run parameters, with environment overrides."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, replace

# Environment variable of each parameter.
ENV = {
    "bootstrap_servers": "KAFKA_BOOTSTRAP_SERVERS",
    "event_topic": "COLLECTOR_EVENT_TOPIC",
    "topic_poll_interval": "COLLECTOR_TOPIC_POLL_INTERVAL",
    "cluster_poll_interval": "COLLECTOR_CLUSTER_POLL_INTERVAL",
    "include_internal": "COLLECTOR_TOPIC_INCLUDE_INTERNAL",
    "allow": "COLLECTOR_TOPIC_WHITELIST",
    "deny": "COLLECTOR_TOPIC_BLACKLIST",
}


def csv_list(text: str) -> tuple[str, ...]:
    """Names between commas, empty ones dropped, blanks kept as they are."""
    return tuple(name for name in text.split(",") if name)


def boolean(text: str) -> bool:
    """A configuration flag in any of its usual spellings."""
    word = text.lower()
    if word in ("true", "yes", "on"):
        return True
    if word in ("false", "no", "off"):
        return False
    raise ValueError(f"not a boolean: {text!r}")


#: Units of a duration as configuration files write them, in microseconds.
UNITS = {
    ("us", "micro", "micros", "microsecond", "microseconds"): 1,
    ("", "ms", "milli", "millis", "millisecond", "milliseconds"): 1_000,
    ("s", "second", "seconds"): 1_000_000,
    ("m", "minute", "minutes"): 60_000_000,
    ("h", "hour", "hours"): 3_600_000_000,
    ("d", "day", "days"): 86_400_000_000,
}


def duration(text: str) -> str:
    """A duration such as ``10s``, ``1 minute`` or ``500`` (milliseconds) as Spark takes it."""
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-z]*)\s*", text)
    unit = next((size for names, size in UNITS.items() if found and found[2] in names), None)
    if unit is None:
        raise ValueError(f"not a duration: {text!r}")
    return f"{round(float(found[1]) * unit)} microseconds"


@dataclass(frozen=True)
class Params:
    bootstrap_servers: str = "localhost:29092"
    event_topic: str = "__collector"
    topic_poll_interval: str = "30 seconds"
    cluster_poll_interval: str = "1 minute"
    include_internal: bool = False
    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "Params":
        env = os.environ if env is None else env
        given = {field: env[name] for field, name in ENV.items() if name in env}
        if "include_internal" in given:
            given["include_internal"] = boolean(given["include_internal"])
        for field in ("allow", "deny"):
            if field in given:
                given[field] = csv_list(given[field])
        return replace(cls(), **given)
