"""Whether a schema holds message keys or values: overrides, patterns, structure, default."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from schemaloom.config import KeyValue
from schemaloom.sources.files import RoleOverrides

#: Built-in patterns in order of precedence (fixed values).
KEY_PATTERNS = ("(?i)[-_]key$", "Key$", "(?i)[-_]id$", "Id$", "ID$", "(?i)identifier$", "(?i)[-_]pk$", "(?i)primarykey$", "(?i)partitionkey$")
VALUE_PATTERNS = ("(?i)[-_]value$", "Value$", "(?i)event$", "(?i)message$", "(?i)payload$", "(?i)data$", "(?i)record$")
#: Parts of field names that tell a key (fixed values).
KEY_FIELDS = ("id", "key", "uuid", "partition_key", "entity_id", "pk")


def java_pattern(pattern: str) -> str:
    """A pattern whose $ means the end of the text only, and whose named groups Java knows."""
    return re.sub(r"(?<!\\)\$", r"\\z", pattern).replace("(?P<", "(?<")


def _first(c: Column, labelled: list[tuple[str, str, str]]) -> Column | None:
    """The first of (pattern, role, label) that matches, as struct(role, reason)."""
    hit = None
    for pattern, role, label in labelled:
        found = F.struct(F.lit(role).alias("role"), F.lit(f"{label}: {pattern}").alias("reason"))
        hit = F.when(c.rlike(java_pattern(pattern)), found) if hit is None else hit.when(c.rlike(java_pattern(pattern)), found)
    return hit


def by_structure(fields: Column) -> Column:
    """One to three fields with an identifier's name make a key, more than five a value, else null."""
    n = F.size(fields)
    like_id = F.exists(fields, lambda f: F.lower(f["name"]).rlike("|".join(KEY_FIELDS)))
    key = F.struct(F.lit("key").alias("role"), F.lit("Structure: few fields with ID-like names").alias("reason"))
    value = F.struct(F.lit("value").alias("role"), F.lit("Structure: many fields").alias("reason"))
    return F.when(n.between(1, 3) & like_id, key).when(n > 5, value)


def detect(registry: Column, name: Column, record: Column, fields: Column | None, settings: KeyValue, overrides: RoleOverrides | None = None) -> Column:
    """struct(role, reason); the settings and overrides are compiled into the expression, the first hit counts."""
    o = overrides or RoleOverrides({})
    built_in = not settings.disable_builtin_patterns
    keys = [(p, "key", "Built-in pattern") for p in KEY_PATTERNS if built_in] + [(p, "key", "User pattern") for p in (*settings.key_regex, *o.key_patterns)]
    values = [(p, "value", "Built-in pattern") for p in VALUE_PATTERNS if built_in] + [(p, "value", "User pattern") for p in (*settings.value_regex, *o.value_patterns)]
    steps: list[Column] = []
    for role in ("key", "value"):
        named = [k for k, v in o.roles.items() if v == role]
        if named:
            found = F.struct(F.lit(role).alias("role"), F.lit("Override file").alias("reason"))
            steps.append(F.when(name.isin(*named), found))
    for role in ("key", "value"):
        named = [k for k, v in o.roles.items() if v == role]
        if named:
            found = F.struct(F.lit(role).alias("role"), F.lit("Override file").alias("reason"))
            steps.append(F.when(F.concat(registry, F.lit("."), name).isin(*named), found))
    for reg, own in (o.registries or {}).items():
        mine = [(p, role, "Registry pattern") for role in ("key", "value") for p in own.get(f"{role}_patterns") or ()]
        if mine:
            steps.append(F.when(registry == reg, _first(name, mine)))
    if keys or values:
        steps.append(_first(name, keys + values))
        steps.append(F.when(record != "", _first(record, [(p, r, "Record name pattern") for p, r, _ in keys + values])))
    if fields is not None:
        steps.append(by_structure(fields))
    default = F.lit(settings.default_role)
    for reg, own in (o.registries or {}).items():
        if own.get("default_role") in ("key", "value"):
            default = F.when(registry == reg, F.lit(own["default_role"])).otherwise(default)
    return F.coalesce(*steps, F.struct(default.alias("role"), F.lit("Default role").alias("reason")))


def suffix(role: Column) -> Column:
    return F.when(role == "key", "-key").otherwise("-value")
