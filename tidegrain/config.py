"""Source, facility, collector, tariff and rule files: each is checked as a whole and all of its problems are reported at once."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path


class ConfigError(ValueError):
    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def text(v) -> str | None:
    return None if isinstance(v, str) and v else "is a text that isn't empty"


def https(v) -> str | None:
    return None if isinstance(v, str) and v.startswith("https://") else f"is an https address, not {v!r}"


def name(v) -> str | None:
    return None if isinstance(v, str) and re.fullmatch("[a-z][a-z0-9_]*", v) else "is of small letters, digits and underscores"


def positive(v) -> str | None:
    return None if isinstance(v, int | float) and not isinstance(v, bool) and v > 0 else "is a positive number"


def whole(v) -> str | None:
    return None if isinstance(v, int) and not isinstance(v, bool) and v > 0 else "is a positive whole number"


def texts(v) -> str | None:
    return None if isinstance(v, list) and all(isinstance(x, str) for x in v) else "is a list of texts"


PLACEHOLDERS = ("{yyyy}", "{mm}", "{dd}", "{HHmmss}")


def raw_path(v) -> str | None:
    places = [v.find(p) for p in PLACEHOLDERS] if isinstance(v, str) else [-1]
    once = -1 not in places and all(v.count(p) == 1 for p in PLACEHOLDERS) and places == sorted(places)
    return None if once and v.endswith(".json") and not v.startswith("/") else f"is a relative .json path with each of {' '.join(PLACEHOLDERS)} once, in order of time"


#: The sections of a source: for each field its rule and its default (... where it has to be there).
SECTIONS = {
    "ckan": {"base_url": (https, ...), "package_id": (text, ...), "format": (text, ...)},
    "http": {"url": (https, ...)},
    "licence": {"id": (text, ...), "url": (https, ...), "publisher": (text, ...)},
    "polling": {"fast_interval_minutes": (positive, 5), "slow_interval_minutes": (positive, 20), "unchanged_snapshots_for_slow": (whole, 5), "change_ignores_fields": (texts, [])},
    "freshness": {"stale_after_minutes": (positive, 15)},
    "glitch": {"max_neighbour_difference": (positive, 10), "min_jump": (positive, 50)},
    "filter": {"field": (text, ...), "mapping_field": (text, ...)},
}
FIELDS = {"id": name, "raw_path": raw_path, "bronze_table": name}


@dataclass(frozen=True)
class Source:
    """A polled feed (or a register, if it has a filter); sections that the file leaves out are empty."""

    id: str
    raw_path: str
    bronze_table: str
    ckan: dict = field(default_factory=dict)
    http: dict = field(default_factory=dict)
    licence: dict = field(default_factory=dict)
    polling: dict = field(default_factory=dict)
    freshness: dict = field(default_factory=dict)
    glitch: dict = field(default_factory=dict)
    filter: dict = field(default_factory=dict)

    @property
    def folder(self) -> str:
        """The part of raw_path that all of the source's files share."""
        return self.raw_path[: self.raw_path.index(PLACEHOLDERS[0])].rstrip("/")

    def raw_file(self, at) -> str:
        return self.raw_path.format(yyyy=f"{at:%Y}", mm=f"{at:%m}", dd=f"{at:%d}", HHmmss=f"{at:%H%M%S}")


def _source(s, at: str, wrong: list[str]) -> Source | None:
    if not isinstance(s, dict):
        wrong.append(f"{at}: not an object")
        return None
    before, out = len(wrong), {}
    wrong += [f"{at}: unknown key {k}" for k in sorted(s.keys() - FIELDS.keys() - SECTIONS.keys())]
    for k, rule in FIELDS.items():
        if problem := rule(s.get(k)):
            wrong.append(f"{at}: {k} {problem}")
        out[k] = s.get(k)
    for section, rules in SECTIONS.items():
        if section not in s:
            continue
        own = s[section]
        if not isinstance(own, dict):
            wrong.append(f"{at}: {section} is an object")
            continue
        wrong += [f"{at}: unknown key {section}.{k}" for k in sorted(own.keys() - rules.keys())]
        out[section] = {}
        for k, (rule, default) in rules.items():
            value = own.get(k, default)
            if value is ... or (problem := rule(value)):
                wrong.append(f"{at}: {section}.{k} " + ("is missing" if value is ... else problem))
            else:
                out[section][k] = value
    if ("ckan" in s) == ("http" in s):
        wrong.append(f"{at}: either ckan or http")
    polling, glitch = out.get("polling") or {}, out.get("glitch") or {}
    if polling.get("fast_interval_minutes", 0) > polling.get("slow_interval_minutes", 1e9):
        wrong.append(f"{at}: the fast interval is at most the slow one")
    if glitch.get("min_jump", 1e9) <= glitch.get("max_neighbour_difference", 0):
        wrong.append(f"{at}: min_jump is over max_neighbour_difference")
    return Source(**out) if len(wrong) == before else None


def load_sources(path: str) -> list[Source]:
    data, wrong = _json(path), []
    entries = data.get("sources") if isinstance(data, dict) else None
    if not isinstance(entries, list) or not entries:
        raise ConfigError([f"{path}: sources is a list that isn't empty"])
    wrong += [f"unknown key {k}" for k in sorted(data.keys() - {"sources"})]
    out = [_source(s, f"sources[{i}]", wrong) for i, s in enumerate(entries)]
    for k in ("id", "bronze_table", "raw_path"):
        wrong += twice(k, [s.get(k) for s in entries if isinstance(s, dict)])
    if wrong:
        raise ConfigError(wrong)
    return out


def twice(label: str, seen: list) -> list[str]:
    return [f"{label} {v} is there twice" for v in sorted({str(v) for v in seen if v is not None and seen.count(v) > 1})]


def load_mapping(path: str) -> list[tuple[str, int | None, int]]:
    """(facility, register_id, reserved_spaces); reserved spaces need a note that says why."""
    wrong, out = [], []
    for i, f in enumerate(_json(path).get("facilities", [])):
        own, rid, res = f.get("facility"), f.get("register_id"), f.get("reserved_spaces", 0)
        if text(own):
            wrong.append(f"facilities[{i}]: facility is missing")
        if rid is not None and (isinstance(rid, bool) or not isinstance(rid, int)):
            wrong.append(f"facilities[{i}]: register_id is an integer")
        if isinstance(res, bool) or not isinstance(res, int) or res < 0:
            wrong.append(f"facilities[{i}]: reserved_spaces is 0 or more")
        elif res and not f.get("note"):
            wrong.append(f"facilities[{i}]: reserved_spaces needs a note")
        out.append((own, rid, res))
    wrong += twice("facility", [x[0] for x in out]) + twice("register_id", [x[1] for x in out])
    if wrong:
        raise ConfigError(wrong)
    return out


@dataclass(frozen=True)
class Collector:
    """Where the collector's run history is read: a workflow of a repository."""

    repository: str
    workflow: str


def load_collector(path: str) -> Collector:
    own = _json(path)
    own = own.get("github_actions") if isinstance(own, dict) else None
    if not isinstance(own, dict):
        raise ConfigError([f"{path}: github_actions is an object"])
    if wrong := [f"{path}: {k} {p}" for k in ("repository", "workflow") if (p := text(own.get(k)))]:
        raise ConfigError(wrong)
    return Collector(own["repository"], own["workflow"])


def load_tariffs(path: str) -> list[dict]:
    """The facilities' periods of a tariff file, as pricing.tariffs() takes them; prices are for half an hour."""
    data = _json(path)
    if not isinstance(data, dict) or data.get("unit") != "half_hour":
        raise ConfigError([f"{path}: unit is half_hour"])
    wrong, out = [], data.get("facilities") or []
    for i, f in enumerate(out):
        if text(f.get("facility")):
            wrong.append(f"facilities[{i}]: facility is missing")
        for j, p in enumerate(f.get("periods") or []):
            at = f"facilities[{i}].periods[{j}]"
            if not isinstance(p.get("price"), int | float) or isinstance(p.get("price"), bool) or p["price"] < 0:
                wrong.append(f"{at}: price is a number of 0 or more")
            wrong += [f"{at}: {k} {problem}" for k in ("from", "to") if (problem := text(p.get(k)))]
            if "weekdays" in p and (not p["weekdays"] or texts(p["weekdays"]) or set(p["weekdays"]) - set(WEEK)):
                wrong.append(f"{at}: weekdays are some of {', '.join(WEEK)}")
    wrong += twice("facility", [f.get("facility") for f in out])
    if wrong or not out:
        raise ConfigError(wrong or [f"{path}: no facilities"])
    return out


WEEK = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")


def load_rules(path: str):
    """The pricing rules of a file; what the rules themselves forbid is reported by Rules."""
    from tidegrain.operators.pricing import PricingError, Rules, whole_hour

    data = _json(path)
    try:
        limits = data["limits"]
        return Rules(
            bands=tuple((b["name"], b.get("below"), float(b["multiplier"])) for b in data["occupancy_bands"]),
            rush=tuple((w["name"], tuple(WEEK.index(d) + 1 for d in w["weekdays"]), whole_hour(w["from"]), whole_hour(w["to"]), float(w["multiplier"])) for w in data.get("rush_hours", [])),
            min_multiplier=float(limits["min_multiplier"]),
            max_multiplier=float(limits["max_multiplier"]),
            limits={f: (v.get("min"), v.get("max")) for f, v in (limits.get("facilities") or {}).items()},
            max_stale_share=float(data["data"]["max_stale_share"]),
            min_covered_minutes=float(data["data"]["min_covered_minutes"]),
        )
    except PricingError as e:
        raise ConfigError([f"{path}: {e}"]) from e
    except (KeyError, TypeError, ValueError, AttributeError) as e:
        raise ConfigError([f"{path}: a field is missing or wrong: {e!r}"]) from e


def _json(path: str):
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError:
        raise ConfigError([f"not found: {path}"]) from None
    except ValueError as e:
        raise ConfigError([f"{path} isn't JSON: {e}"]) from None
