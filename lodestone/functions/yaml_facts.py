"""One parse of a YAML text for everything that is asked of it: an Arrow UDF returning a typed struct.

Null, empty, oversized, hostile and unparseable texts give parsed = false and false or zero elsewhere.
"""

from __future__ import annotations

from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_CHARS = 262_144
FIRST_KEYS = 12

SCHEMA = (
    "parsed boolean, is_k8s boolean, is_gha boolean, is_ansible boolean, is_compose boolean, is_chart_meta boolean, top_keys array<string>, "
    "jobs int, steps int, uses_actions int, triggers array<string>, has_permissions boolean, "
    "services int, built_services int, has_volumes boolean, has_networks boolean, has_healthcheck boolean"
)

# Keys that only a play or a task has.
ANSIBLE_KEYS = {
    "hosts", "tasks", "roles", "handlers", "become", "gather_facts", "vars_files", "pre_tasks", "post_tasks", "include_tasks",
    "import_tasks", "import_playbook", "block", "when", "loop", "with_items", "register", "notify", "delegate_to", "set_fact",
}
NOTHING: dict[str, Any] = {
    "parsed": False, "is_k8s": False, "is_gha": False, "is_ansible": False, "is_compose": False, "is_chart_meta": False, "top_keys": [],
    "jobs": 0, "steps": 0, "uses_actions": 0, "triggers": [], "has_permissions": False,
    "services": 0, "built_services": 0, "has_volumes": False, "has_networks": False, "has_healthcheck": False,
}


def documents(text: str | None) -> list | None:
    """Every document of a text; None when any part does not parse, whatever the parser raises."""
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)  # libyaml's, where it is there
    if text is None or len(text) > MOST_CHARS:
        return None
    try:
        return list(yaml.load_all(text, Loader=loader))
    except Exception:  # hostile tags raise KeyError, ValueError, RecursionError and more
        return None


def _filled(value: Any) -> bool:
    return isinstance(value, str) and bool(value)


def _is_task(entry: Any) -> bool:
    return isinstance(entry, dict) and (any(k in ANSIBLE_KEYS for k in entry if isinstance(k, str)) or "name" in entry and len(entry) > 1)


def facts(text: str | None) -> dict[str, Any]:
    docs = documents(text)
    if docs is None:
        return NOTHING
    out = {**NOTHING, "parsed": True}
    maps = [d for d in docs if isinstance(d, dict)]
    out["is_k8s"] = any(_filled(d.get("apiVersion")) and _filled(d.get("kind")) for d in maps)
    out["is_ansible"] = any(_is_task(e) for d in docs if isinstance(d, list) for e in d)
    first = docs[0] if docs else None
    if not isinstance(first, dict):
        return out
    out["top_keys"] = ["on" if k is True else str(k) for k in list(first)[:FIRST_KEYS]]
    out["is_chart_meta"] = isinstance(first.get("name"), str) and bool(first.get("version"))
    jobs = first.get("jobs")
    if isinstance(jobs, dict):
        runs = [j for j in jobs.values() if isinstance(j, dict)]
        named = "on" in first or True in first  # a bare `on` is a boolean in YAML 1.1
        out["is_gha"] = named and any(k in j for j in runs for k in ("steps", "runs-on", "uses"))
        steps = [s for j in runs if isinstance(j.get("steps"), list) for s in j["steps"] if isinstance(s, dict)]
        out |= {"jobs": len(jobs), "steps": len(steps), "uses_actions": sum("uses" in s for s in steps)}
    on = first.get("on", first.get(True))
    out["triggers"] = (sorted(map(str, on)) if isinstance(on, dict | list) else [] if on is None else [str(on)])[:8]
    services = first.get("services")
    if isinstance(services, dict):
        own = [s for s in services.values() if isinstance(s, dict)]
        out |= {"is_compose": bool(own), "services": len(services), "built_services": sum("build" in s for s in own), "has_healthcheck": any("healthcheck" in s for s in own)}
    out |= {"has_permissions": "permissions" in first, "has_volumes": "volumes" in first, "has_networks": "networks" in first}
    return out


def _batch(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([facts(t) for t in texts], columns=list(NOTHING))


def as_udf():
    """The Arrow UDF; made on call, as it needs a session."""
    _batch.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(_batch, SCHEMA)


def yaml_facts(text: Column | str) -> Column:
    return as_udf()(text)
