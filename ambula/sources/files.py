"""Files from the web, and readers of what the sinks write."""

from __future__ import annotations

import gzip
import json
import os
import subprocess
from pathlib import Path

import numpy as np


def fetch(url: str, target: Path, missing_ok: bool = False) -> Path | None:
    """The file at url, kept at target; with missing_ok an answer that it is not there is kept too, as target.missing."""
    mark = target.with_name(target.name + ".missing")
    if target.exists():
        return target
    if missing_ok and mark.exists():
        return None
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    done = subprocess.run(["curl", "-sSL", "--fail", "--retry", "3", "-o", str(part), url], check=False)
    if done.returncode == 22 and missing_ok:
        mark.touch()
        return None
    if done.returncode:
        raise OSError(f"curl ended with {done.returncode} for {url}")
    os.replace(part, target)
    return target


def read_sites(path: Path) -> list[tuple]:
    return [tuple(s) for s in json.loads(path.read_text())["sites"]]


def read_dirs(path: Path, w: int, h: int) -> np.ndarray:
    """The raster of directions, gzipped or already plain."""
    data = path.read_bytes()
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    return np.frombuffer(data, np.uint8).reshape(h, w)
