"""Run configuration: sections, defaults, YAML in and out, checks that collect every error."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from urllib.parse import urlparse

from schemaloom.sources import files


@dataclass
class Source:
    region: str = "us-east-1"
    registry_names: list[str] = field(default_factory=list)
    registry_all: bool = False
    registry_exclude: list[str] = field(default_factory=list)
    schema_filter: str = ""
    profile: str = ""
    access_key_id: str = ""
    secret_access_key: str = ""


@dataclass
class Target:
    url: str = ""
    api_key: str = ""
    api_secret: str = ""
    set_compatibility: bool = False  # at the target, after a schema's versions
    set_metadata: bool = False


@dataclass
class Naming:
    subject_strategy: str = "topic"
    subject_template: str = ""
    context_mapping: str = "flat"
    context_mapping_file: str = ""
    name_mapping_file: str = ""


@dataclass
class Normalization:
    normalize_dots: str = "replace"
    dot_replacement: str = "-"
    normalize_case: str = "kebab"
    invalid_char_replacement: str = "-"
    collision_check: bool = True
    collision_resolution: str = "suffix"


@dataclass
class KeyValue:
    key_regex: list[str] = field(default_factory=list)
    value_regex: list[str] = field(default_factory=list)
    default_role: str = "value"
    role_override_file: str = ""
    disable_builtin_patterns: bool = False


@dataclass
class Migration:
    version_strategy: str = "all"
    reference_strategy: str = "rewrite"
    cross_registry_refs: str = "resolve"


@dataclass
class Metadata:
    strategy: str = "migrate"
    migrate_tags: bool = True
    migrate_description: bool = True


@dataclass
class Suggestions:
    provider: str = "openai"
    model: str = "gpt-4o"
    api_key: str = ""
    base_url: str = ""
    cache_file: str = ""
    max_cost: float = 0.0
    rate_limit: int = 5
    input_token_cost: float = 0.000005
    output_token_cost: float = 0.000015


@dataclass
class Concurrency:
    workers: int = 10
    batch_size: int = 100
    aws_rate_limit: int = 10
    cc_rate_limit: int = 10
    llm_rate_limit: int = 5
    retry_attempts: int = 3
    retry_delay: float = 5.0  # seconds


@dataclass
class Checkpoint:
    file: str = ""
    resume: bool = False


@dataclass
class Output:
    dry_run: bool = False
    report_file: str = ""
    format: str = "table"
    progress: bool = True
    log_file: str = ""
    log_level: str = "info"


@dataclass
class Config:
    aws: Source = field(default_factory=Source)
    confluent_cloud: Target = field(default_factory=Target)
    naming: Naming = field(default_factory=Naming)
    normalization: Normalization = field(default_factory=Normalization)
    key_value: KeyValue = field(default_factory=KeyValue)
    migration: Migration = field(default_factory=Migration)
    metadata: Metadata = field(default_factory=Metadata)
    llm: Suggestions = field(default_factory=Suggestions)
    concurrency: Concurrency = field(default_factory=Concurrency)
    checkpoint: Checkpoint = field(default_factory=Checkpoint)
    output: Output = field(default_factory=Output)


def _seconds(v) -> float:
    """A duration: a number of seconds or text such as 500ms, 5s, 2m30s."""
    if isinstance(v, (int, float)):
        return float(v)
    units = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}
    parts = re.findall(r"([\d.]+)(ms|s|m|h)", v)
    if not parts or "".join(a + b for a, b in parts) != v:
        raise ValueError(f"not a duration: {v!r}")
    return sum(float(a) * units[b] for a, b in parts)


def apply(config, values: dict):
    """Sets the named values on top of a config; names that it does not have are ignored."""
    known = {f.name for f in fields(config)}
    for k, v in (values or {}).items():
        if k not in known or v is None:
            continue
        now = getattr(config, k)
        if is_dataclass(now):
            apply(now, v)
        else:
            setattr(config, k, _seconds(v) if k == "retry_delay" else v)
    return config


def load(path: str) -> Config:
    return apply(Config(), files.read_yaml(path))


def save(config: Config, path: str) -> None:
    files.write_yaml(path, asdict(config))


@dataclass(frozen=True)
class Problem:
    field: str
    message: str

    def __str__(self) -> str:
        return f"{self.field}: {self.message}"


class ConfigError(ValueError):
    """All problems of a configuration at once."""

    def __init__(self, problems: list[Problem]):
        self.problems = problems
        super().__init__("invalid configuration:\n" + "\n".join(f"  - {p}" for p in problems))


#: Allowed values per setting (fixed values).
CHOICES = {
    "naming.subject_strategy": ("topic", "record", "llm", "custom"),
    "naming.context_mapping": ("registry", "flat", "custom"),
    "normalization.normalize_dots": ("keep", "replace", "extract-last"),
    "normalization.normalize_case": ("keep", "kebab", "snake", "lower"),
    "key_value.default_role": ("key", "value"),
    "migration.version_strategy": ("all", "latest"),
    "migration.reference_strategy": ("rewrite", "skip", "fail"),
    "migration.cross_registry_refs": ("resolve", "fail", "warn"),
    "output.format": ("table", "json", "csv"),
    "output.log_level": ("debug", "info", "warn", "error"),
}
PROVIDERS = ("openai", "anthropic", "bedrock", "ollama", "local")


def problems(c: Config) -> list[Problem]:
    """Every problem of a configuration; empty if it can run."""
    value = lambda path: getattr(getattr(c, path.partition(".")[0]), path.partition(".")[2])
    needed = [("aws.region", True), *((f"confluent_cloud.{k}", not c.output.dry_run) for k in ("url", "api_key", "api_secret")), ("naming.subject_template", c.naming.subject_strategy == "custom"), ("naming.context_mapping_file", c.naming.context_mapping == "custom")]
    if c.naming.subject_strategy == "llm":
        needed += [("llm.model", True), ("llm.api_key", c.llm.provider in ("openai", "anthropic")), ("llm.base_url", c.llm.provider in ("ollama", "local"))]
    found = [Problem(path, "is required") for path, when in needed if when and not value(path)]
    if not c.aws.registry_all and not c.aws.registry_names:
        found.append(Problem("aws.registry_names", "name registries or set registry_all"))
    if not c.output.dry_run and c.confluent_cloud.url and not urlparse(c.confluent_cloud.url).scheme:
        found.append(Problem("confluent_cloud.url", "is no URL"))
    choices = CHOICES | ({"llm.provider": PROVIDERS} if c.naming.subject_strategy == "llm" else {})
    found += [Problem(path, f"must be one of: {', '.join(allowed)}") for path, allowed in choices.items() if value(path) not in allowed]
    for name in ("key_regex", "value_regex"):
        for i, p in enumerate(getattr(c.key_value, name)):
            if (why := files.pattern_problem(p)):
                found.append(Problem(f"key_value.{name}[{i}]", why))
    found += [Problem(f"concurrency.{k}", f"must be at least {least}") for k, least in (("workers", 1), ("batch_size", 1), ("retry_attempts", 0)) if getattr(c.concurrency, k) < least]
    if c.naming.context_mapping == "custom" and c.naming.context_mapping_file:
        found += [Problem("naming.context_mapping_file", m) for m in files.context_mapping_problems(c.naming.context_mapping_file)]
    if c.naming.name_mapping_file:
        found += [Problem("naming.name_mapping_file", m) for m in files.name_mapping_problems(c.naming.name_mapping_file)]
    return found


def check(c: Config) -> Config:
    if found := problems(c):
        raise ConfigError(found)
    return c
