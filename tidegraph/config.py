"""Settings: a TOML file, overlaid by environment variables, checked before any work."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

_UNITS = {"ms": 0.001, "s": 1, "sec": 1, "m": 60, "min": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400, "days": 86400}
_PART = re.compile(r"(\d+(?:\.\d+)?)\s*([a-z]+)")
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def seconds(text: str | float) -> float:
    """A duration such as `24h` or `1m 30s`."""
    if isinstance(text, (int, float)):
        return float(text)
    parts = _PART.findall(text)
    if not parts or _PART.sub("", text).strip() or any(u not in _UNITS for _, u in parts):
        raise ValueError(f"not a duration: {text!r}")
    return sum(float(n) * _UNITS[u] for n, u in parts)


def _polymod(values: list[int]) -> int:
    check = 1
    for v in values:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            check ^= g if top >> i & 1 else 0
    return check


def public_key(text: str) -> bytes:
    """32 bytes of a key in hex or bech32 (npub)."""
    if re.fullmatch("[0-9a-fA-F]{64}", text):
        return bytes.fromhex(text)
    head, _, data = text.rpartition("1")
    values = [_BECH32.find(c) for c in data]
    if head != "npub" or -1 in values or _polymod([ord(c) >> 5 for c in head] + [0] + [ord(c) & 31 for c in head] + values) != 1:
        raise ValueError("not a public key")
    bits = "".join(f"{v:05b}" for v in values[:-6])
    raw = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits) - 7, 8))
    if len(raw) != 32:
        raise ValueError("not a public key")
    return raw


@dataclass(frozen=True)
class Config:
    anchor_pubkey: str
    relays: tuple[str, ...]
    database_url: str = field(repr=False)
    ttl: float
    metrics_addr: str
    concurrency: int = 8
    batch_size: int = 64
    max_attempts: int = 3
    fetch_timeout: float = 30.0
    reqs_per_second: int = 4
    log_level: str = "info"
    log_format: str = "human"
    progress_interval: float = 60.0
    staleness_scan_interval: float = 300.0
    reclaim_interval: float = 60.0
    reclaim_age: float = 300.0
    idle_poll_interval: float = 5.0
    nip65_fallback_enabled: bool = True
    nip65_max_write_relays: int = 3
    relay_health_threshold: float = 0.25
    per_relay_concurrency: int = 4
    health_alpha: float = 0.3

    def validate(self) -> Config:
        public_key(self.anchor_pubkey)
        wrong = [
            (not self.relays, "relays is empty"),
            (self.ttl <= 0, "ttl must be positive"),
            (not self.database_url.strip() or "://" not in self.database_url, "database_url isn't a URL"),
            *[(getattr(self, n) <= 0, f"{n} must be positive") for n in ("concurrency", "batch_size", "reqs_per_second", "nip65_max_write_relays", "per_relay_concurrency")],
            (not 0 <= self.relay_health_threshold <= 1, "relay_health_threshold must be from 0 to 1"),
            (not 0 < self.health_alpha <= 1, "health_alpha must be over 0 and at most 1"),
        ]
        for bad, why in wrong:
            if bad:
                raise ValueError(why)
        return self


def load(path: str, prefix: str, environment: Mapping[str, str] = os.environ) -> Config:
    """Settings of a file; PREFIX__NAME variables win.  Names without a field are errors."""
    with open(path, "rb") as f:
        values = tomllib.load(f)
    names = {f.name: f for f in fields(Config)}
    for key, value in environment.items():
        if key.startswith(f"{prefix}__"):
            values[key[len(prefix) + 2 :].lower()] = value
    out = {}
    for name, value in values.items():
        if name not in names:
            raise ValueError(f"unknown setting {name}")
        kind = names[name].type
        if name == "relays":
            value = tuple(v.strip() for v in value.split(",")) if isinstance(value, str) else tuple(value)
        elif name in ("ttl", "fetch_timeout") or name.endswith(("_interval", "_age")):
            value = seconds(value)
        elif kind == "bool" and isinstance(value, str):
            value = {"true": True, "false": False}[value.lower()]
        elif kind in ("int", "float"):
            value = {"int": int, "float": float}[kind](value)
        out[name] = value
    missing = [n for n in ("anchor_pubkey", "relays", "database_url", "ttl", "metrics_addr") if n not in out]
    if missing:
        raise ValueError(f"missing settings: {', '.join(missing)}")
    return Config(**out)
