"""The control plane: manifests of runs, pointers to complete attempts, path safety, retention. Small documents, plain Python."""

from __future__ import annotations

import json
import os
import re
import shutil
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path, PurePosixPath
from typing import Any
from urllib.parse import quote

from pyspark.sql import SparkSession

from stayspark.sources.checks import Rule, check, counted, filled, one_of, text

MANIFEST = "run_manifest.json"
POINTER = "completed_attempt.json"
RECEIPT = "upload_receipt.json"
BARE = re.compile(r"(?!\.\.?/)[^/]+\.jsonl")
IDS = ("batch_id", "airflow_dag_id", "airflow_run_id")


def _below(root: str) -> tuple[Rule, ...]:
    """Rules of a manifest's path, split into {"path": ...}."""
    return (
        Rule("path", lambda p: p.is_absolute() and ".." not in p.parts, "must be absolute and must not climb"),
        Rule("path", lambda p: p.is_relative_to(root.rstrip("/") or "/"), f"must lie in {root}"),
        Rule("path", lambda p: p.name == MANIFEST, f"must end in {MANIFEST}"),
    )


# What a complete manifest says; a stay's file is a bare name beside it, so no path and no wildcard.
COMPLETE = (
    Rule("", filled(dict), "must be an object"),
    Rule("status", one_of("complete"), "must be complete"),
    *[Rule(key, text, "must be a text") for key in IDS],
    Rule("airflow_try_number", counted, "must be 1 or more"),
    Rule("stays", filled(list), "must list some stays"),
    Rule("stays.*", filled(dict), "must be an object"),
    Rule("stays.*.output_file", lambda v: isinstance(v, str) and BARE.fullmatch(v), "must be a bare .jsonl name"),
    Rule("stays.*.publishable_records", counted, "must be 1 or more"),
    Rule("stays", lambda v: not isinstance(v, list) or max(Counter(str(s.get("output_file")) for s in v if isinstance(s, dict)).values(), default=1) == 1, "must not declare a file twice"),
)


def safe_manifest_path(path: str, root: str) -> PurePosixPath:
    """A manifest's path, absolute, below root and without steps upward."""
    at = PurePosixPath(path)
    check({"path": at}, _below(root), "manifest")
    return at


def parse_manifest(source: str) -> dict[str, Any]:
    try:
        doc = json.loads(source)
    except json.JSONDecodeError as e:
        raise ValueError(f"manifest is no JSON: {e}") from e
    check(doc, COMPLETE[:1], "manifest")
    return doc


def read_manifest(spark: SparkSession, path: str) -> dict[str, Any]:
    """By Spark's reader, so from any store."""
    return parse_manifest("".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect()))


def declared_counts(manifest: dict[str, Any], path: str | PurePosixPath) -> dict[str, int]:
    """Files that a complete manifest declares beside itself, and their numbers of records; all faults are one ValueError."""
    check(manifest, COMPLETE, "manifest")
    beside = PurePosixPath(path).parent
    return {str(beside / stay["output_file"]): stay["publishable_records"] for stay in manifest["stays"]}


def _write(path: Path, doc: dict[str, Any]) -> None:
    """Into a temporary file that then takes the place of the old one, at once."""
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.tmp")
    temporary.write_text(json.dumps(doc, ensure_ascii=False, indent=2))
    os.replace(temporary, path)


def batch_id(dag_id: str, run_id: str) -> str:
    return f"{dag_id}__{run_id}"


def attempt_folder(root: Path, dag_id: str, run_id: str, attempt: int) -> Path:
    safe = lambda x: quote(x, safe="-_.")
    return root / f"dag_id={safe(dag_id)}" / f"batch_id={safe(batch_id(dag_id, run_id))}" / f"attempt={attempt}"


class Run:
    """A run's manifest: running, then complete or failed. An attempt's folder is never written twice."""

    def __init__(self, root: Path, dag_id: str, run_id: str, attempt: int, started_at: datetime, planned: list[dict[str, str]]) -> None:
        self.root, self.folder = root, attempt_folder(root, dag_id, run_id, attempt)
        if self.folder.exists() and any(self.folder.iterdir()):
            raise FileExistsError(f"{self.folder} holds an attempt already")
        self.doc: dict[str, Any] = {"status": "running", "batch_id": batch_id(dag_id, run_id), "airflow_dag_id": dag_id, "airflow_run_id": run_id, "airflow_try_number": attempt, "started_at": started_at.isoformat(), "planned_stays": planned, "stays": []}
        self._save()

    def _save(self) -> None:
        _write(self.folder / MANIFEST, self.doc)

    def add_stay(self, output_file: str, records: int, publishable: int, **more: Any) -> None:
        self.doc["stays"].append({"output_file": output_file, "records": records, "publishable_records": publishable, "discarded_records": records - publishable, **more})
        self._save()

    def fail(self, error: str, at: datetime) -> None:
        self.doc |= {"status": "failed", "error": error, "finished_at": at.isoformat()}
        self._save()

    def complete(self, at: datetime) -> Path:
        """Mark complete, then publish the pointer, in this order."""
        self.doc |= {"status": "complete", "finished_at": at.isoformat()}
        self._save()
        pointer = self.folder.parent / POINTER
        _write(pointer, {k: self.doc[k] for k in (*IDS, "airflow_try_number")} | {"manifest_path": str(self.folder / MANIFEST)})
        return pointer


def validate_local(pointer: Path) -> dict[str, Any]:
    """The manifest a pointer names: identities agree, some record is publishable, files are there and not empty."""
    at = json.loads(pointer.read_text())
    path = Path(at["manifest_path"])
    doc = parse_manifest(path.read_text())
    holds_data = lambda s: (path.parent / s["output_file"]).is_file() and (path.parent / s["output_file"]).stat().st_size > 0
    rules = (
        *[Rule(k, one_of(at.get(k)), "differs from the pointer's") for k in (*IDS, "airflow_try_number")],
        Rule("status", one_of("complete"), "must be complete"),
        Rule("stays", lambda v: sum(int(s.get("publishable_records", 0)) for s in v or []) > 0, "must have a publishable record"),
        Rule("stays.*", holds_data, "has no file, or an empty one"),
    )
    check(doc, rules, "manifest")
    return doc


def land(folder: Path, to: Path) -> dict[str, Any]:
    """Copy an attempt: data files first and the manifest last, as the sign that all is there; a receipt with digests."""
    import hashlib

    doc = parse_manifest((folder / MANIFEST).read_text())
    files = []
    for name in [*[s["output_file"] for s in doc["stays"]], MANIFEST]:
        to.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(folder / name, to / name)
        data = (to / name).read_bytes()
        files.append({"local_file": name, "remote_path": str(to / name), "size_bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()})
    receipt = {k: doc[k] for k in (*IDS, "airflow_try_number")} | {"files": files}
    _write(folder / RECEIPT, receipt)
    return receipt


def expired_attempts(root: Path, now: datetime, days: int, current: str | None = None) -> list[Path]:
    """Attempts that are complete, landed, older than the retention and not of the current batch."""
    out = []
    for manifest in sorted(root.rglob(MANIFEST)):
        try:
            doc = parse_manifest(manifest.read_text())
            finished = datetime.fromisoformat(doc["finished_at"])
        except (ValueError, KeyError, TypeError):
            continue
        if doc.get("status") == "complete" and doc.get("batch_id") != current and (manifest.parent / RECEIPT).is_file() and finished < now - timedelta(days=days):
            out.append(manifest.parent)
    return out


def clean_up(root: Path, now: datetime, days: int = 14, current: str | None = None) -> list[Path]:
    gone = expired_attempts(root, now, days, current)
    for folder in gone:
        shutil.rmtree(folder)
    return gone


def check_arguments(adults: int, rooms: int, children: int, page_limit: int, fields: tuple[str, ...], known: tuple[str, ...]) -> None:
    """Bounds of a crawl's arguments; page_limit 0 is no limit."""
    least = {"adults": (adults, 1), "rooms": (rooms, 1), "children": (children, 0), "page_limit": (page_limit, 0)}
    rules = (Rule("least.*", lambda v: v[0] >= v[1], "is too small"), Rule("fields.*", one_of(*known), "is no known field"))
    check({"least": least, "fields": list(fields)}, rules, "arguments")
