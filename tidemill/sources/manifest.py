"""Manifests of stages: what was made from what, so that unchanged stages are skipped; and published models."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from tidemill.functions.timeaxis import days_between
from tidemill.operators.parse import symbol_index

VERSION = "1.2"


def size_of(path: str | Path) -> int:
    """Bytes of a file or tree; 0 for what isn't there."""
    p = Path(path)
    if p.is_dir():
        return sum(f.stat().st_size for f in p.rglob("*") if f.is_file())
    return p.stat().st_size if p.exists() else 0


def atomic_write(path: str | Path, text: str) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    tmp = p.with_name(p.name + ".tmp")
    with tmp.open("w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    tmp.replace(p)


@dataclass
class Manifest:
    """One output slot of a stage. Fingerprints are sizes; `strict` adds times of change."""

    folder: str | Path
    stage: str
    slot: str
    strict: bool = False

    @property
    def path(self) -> Path:
        return Path(self.folder) / f"{self.stage}.{self.slot}.manifest.json"

    def _print(self, path: str | Path | Sequence[str]) -> dict[str, Any]:
        """Of a file or tree, or of several files: their sizes one by one, so that none stands in for another."""
        if not isinstance(path, str | Path):
            each = [self._print(x) for x in sorted(path)]
            return {"file": [x["file"] for x in each], "size": [x["size"] for x in each]} | ({"mtime": [x.get("mtime") for x in each]} if self.strict else {})
        out: dict[str, Any] = {"file": str(path), "size": size_of(path)}
        if self.strict and Path(path).exists():
            out["mtime"] = Path(path).stat().st_mtime_ns
        return out

    def commit(self, source: str | Path | Sequence[str], output: str | Path, rows: int, index: Mapping[str, tuple[int, int]] | None = None) -> dict[str, Any]:
        doc = {"version": VERSION, "stage": self.stage, "created_at": datetime.now(UTC).isoformat(), "upstream": self._print(source), "output": self._print(output) | {"rows": rows}}
        if index is not None:
            doc["index"] = {"type": "symbol_slice", "slices": {k: list(v) for k, v in index.items()}}
        atomic_write(self.path, json.dumps(doc, indent=1))
        return doc

    def load(self) -> dict[str, Any] | None:
        return json.loads(self.path.read_text()) if self.path.exists() else None

    def changed(self, source: str | Path | Sequence[str]) -> bool:
        """Whether the stage has to run: no manifest, another source, or an output that is gone or altered."""
        doc = self.load()
        if doc is None:
            return True
        now = self._print(source)
        if any(doc["upstream"].get(k) != v for k, v in now.items() if k != "file"):
            return True
        out = doc["output"]
        return not Path(out["file"]).exists() or size_of(out["file"]) != out["size"]


class Slices:
    """Symbols of a table that has a committed index. Reading one is a filter, which prunes row groups of a table written in symbol order."""

    def __init__(self, manifest: Manifest, df: DataFrame):
        doc = manifest.load()
        if not doc or doc.get("index", {}).get("type") != "symbol_slice":
            raise RuntimeError(f"no symbol index: {manifest.path}")
        self.index = {k: tuple(v) for k, v in doc["index"]["slices"].items()}
        self.df = df

    def symbols(self) -> list[str]:
        return sorted(self.index)

    def get(self, symbol: str) -> DataFrame:
        if symbol not in self.index:
            raise KeyError(symbol)
        return self.df.where(self.df.symbol == symbol)

    def __iter__(self):
        return ((s, self.get(s)) for s in self.symbols() if self.index[s][1])


def index_of(df: DataFrame) -> dict[str, tuple[int, int]]:
    """The index for a manifest: one entry for each symbol, of which an exchange has some thousands."""
    return {r.symbol: (r.start, r.length) for r in symbol_index(df).collect()}


def repair(folder: str | Path, raw: str | Path, first: date, last: date) -> dict[str, str]:
    """Manifests for raw files of each day; a day that fails is reported, the others go on."""
    out = {}
    for day in days_between(first, last):
        try:
            files = sorted((Path(raw) / day.isoformat()).iterdir())
            for f in files:
                Manifest(Path(folder) / day.isoformat(), "download", f.stem).commit(f, f, 0)
            out[day.isoformat()] = f"{len(files)} files"
        except OSError as e:
            out[day.isoformat()] = f"failed: {e}"
    return out


def promote(artifact: str | Path, models: str | Path, name: str, version: str | None = None) -> Path:
    """Publish a run's artifact as models/name/version and point `latest` at it."""
    target = Path(models) / name / (version or date.today().isoformat())
    if not (Path(artifact) / "artifact.json").exists():
        raise FileNotFoundError(f"no artifact in {artifact}")
    shutil.copytree(artifact, target, dirs_exist_ok=True)
    link, tmp = target.parent / "latest", target.parent / ".latest"
    tmp.unlink(missing_ok=True)
    tmp.symlink_to(target.name)
    tmp.replace(link)
    return target


def existing_days(root: str | Path, days: Iterable[date]) -> list[date]:
    return [d for d in days if (Path(root) / d.isoformat()).is_dir()]
