"""Documents around a run: the preflight gate and the record of what was run with which parameters."""

from __future__ import annotations

import hashlib
import json
import math
import os
import shlex
from collections.abc import Callable
from dataclasses import asdict
from pathlib import Path
from typing import Any

from strandmark.operators import parameters as P
from strandmark.schema import Params

#: Versions of the two documents.
PREFLIGHT_VERSION, RUN_INFO_VERSION = 1, 10
PATHS = ["input", "fasta", "genome_blacklist", "outdir", "ref_cache"]


def json_safe(value: Any) -> Any:
    """value with only what JSON knows: other mappings and sequences as objects and arrays, paths and the rest as text."""
    if value is None or isinstance(value, (bool, int, str)) or isinstance(value, float) and math.isfinite(value):
        return value
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, frozenset)):
        return [json_safe(v) for v in (sorted(value, key=str) if isinstance(value, (set, frozenset)) else value)]
    return str(value)


def document_text(document: Any) -> str:
    return json.dumps(json_safe(document), indent=2, sort_keys=True) + "\n"


def absolute(path: str, base: str | None = None) -> str:
    """A local path made absolute against ``base``; empty ones and those of other file systems as they are."""
    if not path or "://" in path:
        return path
    path = os.path.expanduser(path)
    return os.path.normpath(path if os.path.isabs(path) else os.path.join(base or os.getcwd(), path))


def quoted(value: str) -> str:
    """For a shell."""
    return shlex.quote(value)


def is_local_image(container: str) -> bool:
    """Whether a container is an image file rather than an address."""
    return "://" not in container and (container.startswith(("/", "./", "../")) or container.endswith(".sif"))


def resolved_container(container: str, base: str | None = None) -> str:
    return absolute(container, base) if is_local_image(container) else container


def _creatable(path: str) -> bool:
    """Whether a folder is there or could be made, and written to."""
    place = Path(path)
    while not place.exists() and place != place.parent:
        place = place.parent
    return place.is_dir() and os.access(place, os.W_OK | os.X_OK)


def preflight_faults(document: dict[str, Any], schema: dict[str, Any], readable: Callable[[str], bool] = lambda p: os.path.isfile(p) and os.access(p, os.R_OK), creatable: Callable[[str], bool] = _creatable) -> list[str]:
    """All that keeps a run with document = {parameters, paths} from starting."""
    given, paths = document.get("parameters"), document.get("paths")
    if not isinstance(given, dict) or not isinstance(paths, dict):
        return ["the document needs parameters and paths"]
    out = [f"path {p} is missing" for p in PATHS if not isinstance(paths.get(p), str)]
    out += P.object_faults(given, schema)
    out += [f"{p} is required" for p in ("input", "genome") if not str(given.get(p) or "").strip()]
    genomes = given.get("genomes")
    out += P.alias_clashes(genomes) if isinstance(genomes, dict) else []
    files = {p: paths[p] for p in ("input", "fasta") if isinstance(paths.get(p), str)} | ({"genome_blacklist": paths["genome_blacklist"]} if paths.get("genome_blacklist") else {})
    containers = given.get("containers")
    files |= {f"container {k}": str(v) for k, v in containers.items() if is_local_image(str(v))} if isinstance(containers, dict) else {}
    out += [f"{name} can't be read: {path}" for name, path in files.items() if not readable(path)]
    binds = given.get("container_bind_paths")
    out += [f"no such folder: {p}" for p in binds if not (os.path.isdir(p) and os.access(p, os.R_OK))] if isinstance(binds, list) else []
    out += [f"{p} can't be made: {paths[p]}" for p in ("outdir", "ref_cache") if isinstance(paths.get(p), str) and not creatable(paths[p])]
    return out


def preflight(document: dict[str, Any], schema: dict[str, Any], **access: Callable[[str], bool]) -> dict[str, Any]:
    """The document that opens the gate: status, digests of what was checked, resolved paths. ValueError with all faults."""
    if found := preflight_faults(document, schema, **access):
        raise ValueError("\n".join(found))
    digest = lambda d: hashlib.sha256(document_text(d).encode()).hexdigest()
    return {"schema_version": PREFLIGHT_VERSION, "status": "PASS", "parameters_sha256": digest(document), "schema_sha256": digest(schema), "resolved_paths": document["paths"], "warnings": []}


def run_info(params: Params, ready: dict[str, Any], chunks: int, genome: str = "", resolved_genome: str = "", **more: Any) -> dict[str, Any]:
    """The record of a run; ``ready`` is the preflight's document, without which there is none. Effective thresholds: those
    after ``keep_multimappers`` has set its minima to zero. more: what else is to be kept, as containers and their sources."""
    if ready.get("status") != "PASS":
        raise ValueError("the preflight hasn't passed")
    values = asdict(params)
    part = lambda prefix: {k.removeprefix(prefix): v for k, v in values.items() if k.startswith(prefix)}
    paths = ready["resolved_paths"]
    cleavage = {k: values[k] for k in ("artifact_window", "max_softclip_fraction", "max_indel_fraction", "min_support_mean_mapq", "control_min_depth", "control_max_fraction", "control_min_fold", "control_max_q")}
    overrides = ["digenome_min_mapq=0", "ndigenome_min_mapq=0", "cleavage_min_support_mean_mapq=0"]
    return {
        "schema_version": RUN_INFO_VERSION,
        "analysis": params.analysis,
        "requested_genome": genome,
        "resolved_genome": resolved_genome or genome,
        "fasta": paths.get("fasta", ""),
        "ref_cache": paths.get("ref_cache", ""),
        "genome_blacklist": paths.get("genome_blacklist", ""),
        "keep_multimappers": params.keep_multimappers,
        "multimapper_counting": {"primary_alignments": "once, at the primary placement", "secondary_and_supplementary_alignments": "diagnostic only"},
        "automatic_overrides": overrides if params.keep_multimappers else [],
        "cleavage": {"chunks": chunks, "cpus_per_chunk": 1, "interval_padding": params.padding} | cleavage,
        "digenome": part("digenome_"),
        "ndigenome": part("ndigenome_"),
        "parameters_sha256": ready["parameters_sha256"],
    } | json_safe(more)
