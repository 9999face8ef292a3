"""Checks of a parameter document against a schema of types, enums, bounds and required keys."""

from __future__ import annotations

from typing import Any

_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def fits(value: Any, kind: str) -> bool:
    if kind not in _KINDS:
        raise ValueError(f"unknown type {kind!r} in the schema")
    return isinstance(value, _KINDS[kind]) and (kind == "boolean" or not isinstance(value, bool))


def faults(name: str, value: Any, rule: dict[str, Any]) -> list[str]:
    kinds = rule.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(fits(value, k) for k in kinds):
        return [f"{name} must be {' or '.join(kinds)}"]
    out = []
    if "enum" in rule and value not in rule["enum"]:
        out.append(f"{name} must be one of {rule['enum']}")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in rule and value < rule["minimum"]:
            out.append(f"{name} must be at least {rule['minimum']}")
        if "maximum" in rule and value > rule["maximum"]:
            out.append(f"{name} must be at most {rule['maximum']}")
    if isinstance(value, str) and len(value) < rule.get("minLength", 0):
        out.append(f"{name} must have {rule['minLength']} characters or more")
    if isinstance(value, list) and "items" in rule:
        for k, x in enumerate(value):
            out += faults(f"{name}[{k}]", x, rule["items"])
    if isinstance(value, dict) and len(value) < rule.get("minProperties", 0):
        out.append(f"{name} must have {rule['minProperties']} entries or more")
    if isinstance(value, dict) and ("properties" in rule or "additionalProperties" in rule or "required" in rule):
        out += object_faults(value, rule, f"{name}.")
    return out


def object_faults(document: dict[str, Any], schema: dict[str, Any], prefix: str = "") -> list[str]:
    known = schema.get("properties", {})
    out = [f"{prefix}{k} is missing" for k in schema.get("required", []) if document.get(k) is None]
    rest = schema.get("additionalProperties", True)
    for k, v in document.items():
        if k in known:
            if v is not None or k in schema.get("required", []):
                out += faults(prefix + k, v, known[k]) if v is not None else []
        elif rest is False:
            out.append(f"{prefix}{k} is unknown")
        elif isinstance(rest, dict):
            out += faults(prefix + k, v, rest)
    return out


def check(document: dict[str, Any], schema: dict[str, Any]) -> None:
    """Raises ValueError with all faults."""
    if found := object_faults(document, schema):
        raise ValueError("\n".join(found))


def resolve_genome(name: str, genomes: dict[str, dict[str, Any]]) -> str:
    """The genome of this name or alias, in any case of letters; ValueError if none or several."""
    wanted = name.strip().lower()
    hits = sorted({g for g, d in genomes.items() if wanted in {g.lower(), *(str(a).strip().lower() for a in d.get("aliases", []))}})
    if len(hits) != 1:
        raise ValueError(f"genome {name!r}: {'ambiguous: ' + ', '.join(hits) if hits else 'unknown'}")
    return hits[0]


def alias_clashes(genomes: dict[str, dict[str, Any]]) -> list[str]:
    seen: dict[str, str] = {}
    out = []
    for g, d in genomes.items():
        for a in {g.lower(), *(str(x).strip().lower() for x in d.get("aliases", []))}:
            if seen.setdefault(a, g) != g:
                out.append(f"{a}: {seen[a]}, {g}")
    return out
