"""Settings: files over defaults, variables over files, paths, secrets and keyword lists."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from pathlib import Path

from headwater.sources.articles import merged, setting, settings

#: Defaults.
DEFAULTS = {
    "query": "", "maxrecords": 250, "sleep_seconds": 5, "max_split_depth": 4,
    "judge": {"backend": "rules", "similarity_threshold": 0.4},
    "brief": {"max_groups": 5, "min_groups": 3, "max_keywords": 8, "first_seen_lookback_days": 7, "average_window_days": 7, "average_min_days": 3},
    "report": {"top_keywords": 5},
    "notify": {"dry_run": True, "slack_enabled": True, "notion_enabled": False},
    "paths": {"data_dir": "data", "articles": "data/articles", "decisions": "data/decisions", "runs": "data/runs", "briefs_dir": "data/briefs", "reports_dir": "data/reports", "raw_dir": "data/raw"},
}
#: Variables by name with their place and kind, and those that hold secrets.
VARIABLES = {
    "QUERY": ("query", "str"), "MAXRECORDS": ("maxrecords", "int"), "SLEEP_SECONDS": ("sleep_seconds", "float"), "MAX_SPLIT_DEPTH": ("max_split_depth", "int"),
    "BACKEND": ("judge.backend", "str"), "MODEL": ("judge.model", "str"), "SIMILARITY": ("judge.similarity_threshold", "float"), "LOOKBACK_DAYS": ("brief.first_seen_lookback_days", "int"),
    "TOP_KEYWORDS": ("report.top_keywords", "int"), "DRY_RUN": ("notify.dry_run", "bool"), "SLACK_ENABLED": ("notify.slack_enabled", "bool"), "NOTION_ENABLED": ("notify.notion_enabled", "bool"), "DATA_DIR": ("paths.data_dir", "path"),
}
SECRETS = {"slack_webhook": "SLACK_WEBHOOK_URL", "notion_token": "NOTION_TOKEN", "notion_parent_page_id": "NOTION_PARENT_PAGE_ID"}
TRUE, FALSE = ("1", "true", "yes", "y", "on", "참", "예"), ("0", "false", "no", "n", "off", "거짓", "아니오")
PREFIX, FREE = "HEADWATER_", "HEADWATER_CFG__"


def placed(config: dict, dotted: str, value) -> dict:
    """A copy of the settings with a value at its dotted name."""
    for key in reversed(dotted.split(".")):
        value = {key: value}
    return merged(config, value)


def cast(value: str, kind: str, name: str, root: Path):
    if kind == "bool":
        low = value.lower()
        if low not in TRUE + FALSE:
            raise ValueError(f"{name} should be true or false, not {value}")
        return low in TRUE
    if kind == "path":
        return str(root / Path(value).expanduser())
    try:
        return {"int": int, "float": float, "str": str}[kind](value)
    except ValueError:
        raise ValueError(f"{name} should be a number, not {value}") from None


def with_variables(config: dict, environ: Mapping[str, str], root: Path) -> dict:
    """Settings from known variables, each of its kind, and from free ones (PREFIX + judge__threshold), read as JSON where they are. Blank ones don't count."""
    for name, (dotted, kind) in VARIABLES.items():
        value = str(environ.get(PREFIX + name) or "").strip()
        if value:
            config = placed(config, dotted, cast(value, kind, PREFIX + name, root))
    for name, value in environ.items():
        dotted = name[len(FREE) :].replace("__", ".").lower() if name.startswith(FREE) else ""
        if dotted:
            try:
                value = json.loads(value)
            except ValueError:
                value = value.strip()
            config = placed(config, dotted, value)
    return config


def load(root: str, environ: Mapping[str, str] | None = None) -> dict:
    """The settings of a project: ``config/settings.json`` and ``config/keywords.json`` over the defaults, then variables; paths are absolute, secrets show only as whether they are set."""
    environ, base = os.environ if environ is None else environ, Path(root).expanduser().resolve()
    config = merged(DEFAULTS, settings(str(base / "config/settings.json")))
    config = with_variables({**config, "keywords": settings(str(base / "config/keywords.json")), "root": str(base)}, environ, base)
    paths = {k: str(base / Path(str(v)).expanduser()) for k, v in (config.get("paths") or {}).items() if v}
    return {**config, "paths": {"root": str(base), **paths}, "secrets": {k: bool(str(environ.get(v) or "").strip()) for k, v in SECRETS.items()}}


def watch_keywords(config: dict) -> list[str]:
    """Names of the watched keywords, from texts or objects, without repeats."""
    own = config.get("keywords") if isinstance(config.get("keywords"), dict) else {}
    items = own.get("keywords") or own.get("list") or own.get("items") or []
    names = [str(x.get("keyword") or x.get("name") or "") if isinstance(x, dict) else x if isinstance(x, str) else "" for x in items]
    return list(dict.fromkeys(n.strip() for n in names if n.strip()))


def word_list(config: dict, name: str, default: list[str]) -> list[str]:
    """A list of words. An empty one disables; only an absent key means the default."""
    found = setting(config, f"keywords.{name}", None)
    return [str(w).strip() for w in found if str(w).strip()] if isinstance(found, list) else list(default)
