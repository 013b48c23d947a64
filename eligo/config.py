"""Run configuration: one frozen object per classification run."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
import uuid
from collections.abc import Mapping

from eligo import constants as K

DIALECTS = ("d3", "d2", "d1")

# A run id names a directory of the result tables, so only characters that paths never escape are allowed.
RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


@dataclasses.dataclass(frozen=True)
class RunConfig:
    """Parameters of one classification run.

    ``dialect`` selects the rule set: ``d3`` (canonical), ``d2`` (older
    per-person rules: strict pending rules, restricted same-day flag,
    lifetime count over Automatic/Petition only, calendar-year pending
    windows) or ``d1`` (first rule table).
    """

    id: str = "default"
    cutoff_date: str = K.DEFAULT_CUTOFF
    covered_sections_a: tuple[str, ...] = K.COVERED_SECTIONS_A
    covered_sections_b: tuple[str, ...] = K.COVERED_SECTIONS_B
    covered_sections_b_misdemeanor: tuple[str, ...] = K.COVERED_SECTIONS_B_MISDEMEANOR
    excluded_sections_twelve: tuple[str, ...] = K.EXCLUDED_SECTIONS_TWELVE
    years_since_arrest: int = K.YEARS_SINCE_ARREST
    years_since_felony: int = K.YEARS_SINCE_FELONY
    years_until_conviction_after_misdemeanor: int = K.YEARS_AFTER_MISDEMEANOR
    years_until_conviction_after_felony: int = K.YEARS_AFTER_FELONY
    lifetime_rule: bool = True
    sameday_rule: bool = True
    dialect: str = "d3"
    # Drop rows on or after the cutoff (the older rules had no such filter).
    apply_cutoff: bool = True
    lifetime_limit: int = K.LIFETIME_LIMIT

    def __post_init__(self):
        if self.dialect not in DIALECTS:
            raise ValueError(f"unknown dialect {self.dialect!r}; expected one of {DIALECTS}")
        if not RUN_ID.fullmatch(self.id):
            raise ValueError(f"run id {self.id!r}: letters, digits, '.', '_' and '-' only, a letter or digit first")
        dt.date.fromisoformat(self.cutoff_date)
        for name in ("years_since_arrest", "years_since_felony",
                     "years_until_conviction_after_misdemeanor", "years_until_conviction_after_felony"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must be >= 0")
        if self.lifetime_limit < 0:
            raise ValueError("lifetime_limit must be >= 0")

    @property
    def days_per_year(self) -> float:
        return K.DAYS_PER_YEAR if self.dialect == "d3" else K.DAYS_PER_YEAR_JULIAN

    def resolved(self) -> "RunConfig":
        """Resolve ``id='randomize'`` to one UUID, made once on the driver and used everywhere."""
        if self.id == "randomize":
            return dataclasses.replace(self, id=str(uuid.uuid4()))
        return self

    @classmethod
    def from_mapping(cls, values: Mapping) -> "RunConfig":
        """Build from a plain mapping (e.g. a parsed YAML file); ``run_id`` is accepted for ``id``."""
        data = dict(values)
        if "run_id" in data:
            data["id"] = data.pop("run_id")
        names = {f.name for f in dataclasses.fields(cls)}
        unknown = set(data) - names
        if unknown:
            raise ValueError(f"unknown config keys: {sorted(unknown)}")
        for key, value in list(data.items()):
            if isinstance(value, list):
                data[key] = tuple(value)
            if isinstance(value, (dt.date, dt.datetime)):
                data[key] = value.isoformat()[:10]
        return cls(**data)

    def to_row(self) -> dict:
        """Values for the ``runs`` table (the lists become arrays)."""
        row = dataclasses.asdict(self)
        for key in ("covered_sections_a", "covered_sections_b",
                    "covered_sections_b_misdemeanor", "excluded_sections_twelve"):
            row[key] = list(row[key])
        return row


def read_values(path: str) -> dict:
    """The mapping in a file (YAML when PyYAML is installed, else JSON)."""
    with open(path) as fh:
        text = fh.read()
    try:
        import yaml  # optional
        values = yaml.safe_load(text)
    except ImportError:
        import json
        values = json.loads(text)
    return values or {}


def load_config(path: str) -> RunConfig:
    """Read a run configuration file."""
    return RunConfig.from_mapping(read_values(path))
