"""Rule parameters. Their values become literals in the query plans."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any


def _at_least_one(owner: object, *names: str) -> None:
    for name in names:
        value = getattr(owner, name)
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            raise ValueError(f"{type(owner).__name__}.{name} must be an integer of at least 1, got {value!r}")


def _list_of(owner: object, name: str, kind: type) -> None:
    value = getattr(owner, name)
    if isinstance(value, str) or not all(isinstance(v, kind) and not isinstance(v, bool) for v in value):
        raise ValueError(f"{type(owner).__name__}.{name} must be a list of {kind.__name__}")
    object.__setattr__(owner, name, tuple(value))


@dataclass(frozen=True)
class BruteForce:
    threshold: int = 4
    window_seconds: int = 300

    def __post_init__(self) -> None:
        _at_least_one(self, "threshold", "window_seconds")


@dataclass(frozen=True)
class UserEnumeration:
    distinct_user_threshold: int = 2
    window_seconds: int = 300

    def __post_init__(self) -> None:
        _at_least_one(self, "distinct_user_threshold", "window_seconds")


@dataclass(frozen=True)
class SuccessAfterFailures:
    failure_threshold: int = 3
    window_seconds: int = 300

    def __post_init__(self) -> None:
        _at_least_one(self, "failure_threshold", "window_seconds")


@dataclass(frozen=True)
class InterfaceFlap:
    window_seconds: int = 300

    def __post_init__(self) -> None:
        _at_least_one(self, "window_seconds")


@dataclass(frozen=True)
class SuspiciousSudo:
    keywords: tuple[str, ...] = ("/etc/shadow", "/etc/sudoers", "useradd", "chmod 777", "visudo")

    def __post_init__(self) -> None:
        _list_of(self, "keywords", str)


@dataclass(frozen=True)
class Aws:
    public_admin_ports: tuple[int, ...] = (22, 3389)
    privileged_policies: tuple[str, ...] = ("AdministratorAccess", "IAMFullAccess")

    def __post_init__(self) -> None:
        _list_of(self, "public_admin_ports", int)
        _list_of(self, "privileged_policies", str)


@dataclass(frozen=True)
class Scale:
    """How the work is spread; it changes no result. ``salts``: tasks that share a busy key's events."""

    salts: int = 8

    def __post_init__(self) -> None:
        _at_least_one(self, "salts")


@dataclass(frozen=True)
class DetectionSettings:
    linux_brute_force: BruteForce = field(default_factory=BruteForce)
    linux_user_enumeration: UserEnumeration = field(default_factory=UserEnumeration)
    successful_login_after_failures: SuccessAfterFailures = field(default_factory=SuccessAfterFailures)
    cisco_interface_flap: InterfaceFlap = field(default_factory=InterfaceFlap)
    suspicious_sudo: SuspiciousSudo = field(default_factory=SuspiciousSudo)
    aws: Aws = field(default_factory=Aws)
    # None: one group per key over the whole run. A date_trunc unit such as "hour" scopes the
    # grouped correlations to that batch of time.
    batch_unit: str | None = None
    scale: Scale = field(default_factory=Scale)

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> DetectionSettings:
        """Build from a parsed configuration; every rule section is required, unknown keys are errors."""
        sections = {f.name: f.default_factory for f in fields(cls) if f.name not in ("batch_unit", "scale")}
        _check_keys("detection", raw, set(sections) | {"batch_unit", "scale"}, set(sections))
        built: dict[str, Any] = {}
        for name, kind in {**sections, "scale": Scale}.items():
            if name not in raw:
                continue
            names = {f.name for f in fields(kind)}
            _check_keys(name, raw[name], names, set() if name == "scale" else names)
            built[name] = kind(**raw[name])
        return cls(batch_unit=raw.get("batch_unit"), **built)


def _check_keys(where: str, raw: Any, allowed: set[str], required: set[str]) -> None:
    if not isinstance(raw, Mapping):
        raise ValueError(f"{where} must be a mapping")
    unknown, missing = set(raw) - allowed, required - set(raw)
    if unknown or missing:
        raise ValueError(f"{where}: unknown keys {sorted(unknown)}, missing keys {sorted(missing)}")


def load_settings(path: str | Path) -> DetectionSettings:
    """Read a YAML (or JSON) configuration file with one top-level ``detection`` mapping."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        if str(path).endswith(".json"):
            raw = json.loads(text)
        else:
            import yaml

            raw = yaml.safe_load(text)
        _check_keys("configuration", raw, {"detection"}, {"detection"})
        return DetectionSettings.from_mapping(raw["detection"])
    except Exception as error:
        raise ValueError(f"Invalid detection configuration: {path}: {error}") from error
