"""Driver-side files: YAML settings, name and context mappings, role overrides, the ledger of a run."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass


def read_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def write_yaml(path: str, values: dict) -> None:
    import yaml

    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(values, f, sort_keys=False)


def pattern_problem(pattern: str) -> str | None:
    """Why a user pattern cannot be used, or None. Only syntax that the common regex dialects share is accepted."""
    if re.search(r"\(\?(?:=|!|<=|<!|>)|[*+?}]\+|\\[1-9]", pattern):
        return "look-around, possessive quantifiers and back-references are not supported"
    try:
        re.compile(pattern)
    except re.error as e:
        return f"invalid pattern: {e}"
    return None


@dataclass(frozen=True)
class NameMapping:
    """A mapping of a schema, or of registry:schema, to a subject."""

    source: str
    subject: str
    role: str = ""
    context: str = ""


def name_mappings(path: str) -> list[NameMapping]:
    """All three styles of a mapping file; of repeated sources the last, extended ones count last."""
    data = read_yaml(path)
    plain = [NameMapping(s, t or "") for part in ("mappings", "qualified_mappings") for s, t in (data.get(part) or {}).items()]
    extended = [NameMapping(e.get("source") or "", e.get("subject") or "", e.get("role") or "", e.get("context") or "") for e in data.get("extended_mappings") or []]
    return list({m.source: m for m in [*plain, *extended]}.values())


def name_mapping_problems(path: str) -> list[str]:
    try:
        data = read_yaml(path)
    except Exception as e:  # the file's fault, whatever it is
        return [f"cannot be read: {e}"]
    rows = [(part, s, t, "") for part in ("mappings", "qualified_mappings") for s, t in (data.get(part) or {}).items()]
    rows += [(f"extended_mappings[{i}]", e.get("source"), e.get("subject"), e.get("role") or "") for i, e in enumerate(data.get("extended_mappings") or [])]
    found, seen = [], set()
    for part, source, subject, role in rows:
        if not source:
            found.append(f"{part}: a source is required")
        if not subject:
            found.append(f"{part}: {source!r} has no subject")
        if part == "qualified_mappings" and ":" not in source:
            found.append(f"{part}: {source!r} must be registry:schema")
        if role not in ("", "key", "value"):
            found.append(f"{part}: role must be key or value, not {role!r}")
        if source and source in seen:
            found.append(f"{part}: {source!r} is a duplicate")
        seen.add(source)
    return found


def context_mappings(path: str) -> dict[str, str]:
    return {str(k): str(v) for k, v in read_yaml(path).items()}


def context_mapping_problems(path: str) -> list[str]:
    try:
        data = read_yaml(path)
        if not isinstance(data, dict):
            return ["must map registries to contexts"]
    except Exception as e:
        return [f"cannot be read: {e}"]
    return [f"empty registry or context: {k!r}: {v!r}" for k, v in data.items() if not k or not v]


@dataclass(frozen=True)
class RoleOverrides:
    """Roles by schema or registry.schema name, further patterns, and patterns (with a default) per registry."""

    roles: dict[str, str]
    key_patterns: tuple[str, ...] = ()
    value_patterns: tuple[str, ...] = ()
    registries: dict[str, dict] | None = None


def role_overrides(path: str) -> RoleOverrides:
    """A role file, either with its sections or as a flat map of names to roles."""
    data = read_yaml(path)
    sections = {"overrides", "key_patterns", "value_patterns", "registries"}
    roles = data.get("overrides") or {} if sections & set(data) else data
    return RoleOverrides({k: "key" if v == "key" else "value" for k, v in roles.items()}, tuple(data.get("key_patterns") or ()), tuple(data.get("value_patterns") or ()), data.get("registries") or {})


def load_state(path: str) -> dict:
    """The state of a run; a missing or damaged file raises, absent maps are empty."""
    with open(path, encoding="utf-8") as f:
        state = json.load(f)
    for k in ("completed_schemas", "failed_schemas"):
        state[k] = state.get(k) or {}
    return state


def save_state(path: str, state: dict) -> None:
    """Writes the state whole, by renaming, so that a crash leaves the former one."""
    with open(path + ".new", "w", encoding="utf-8") as f:
        json.dump(state, f, indent=2, default=str)
    os.replace(path + ".new", path)


def delete_state(path: str) -> None:
    if os.path.exists(path):
        os.remove(path)
