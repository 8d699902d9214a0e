"""Thresholds and switches, from YAML files where there are any."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass
class Thresholds:
    mask_iou_target: float = 0.85
    seq_match_accuracy_target: float = 0.95
    artifact_naming_accuracy_target: float = 0.98
    text_recall_target: float = 0.92
    max_iteration: int = 3
    no_improve_rounds: int = 2
    pending_pause_ratio: float = 0.20
    confidence: dict = field(default_factory=lambda: {"chain123": 0.95, "chain12": 0.85, "chain13": 0.85, "chain23": 0.70, "chain2": 0.60, "chain3": 0.50})
    timeouts: dict = field(default_factory=lambda: {"vlm": 30.0, "sam": 20.0, "ocr": 10.0})
    rate_limits: dict = field(default_factory=dict)


@dataclass
class Flags:
    s3_llm_confirm: bool = True
    s9_loop: bool = True
    rotation_correct: bool = True
    require_human: bool = False


#: where a file's sections hold a field
_PLACES = {"mask_iou_target": ("mask", "iou_target"), "max_iteration": ("loop", "max_iteration"), "no_improve_rounds": ("loop", "no_improve_rounds"), "pending_pause_ratio": ("review", "pending_pause_ratio"), "timeouts": ("capability", "timeouts"), "rate_limits": ("capability", "rate_limits"), "confidence": ("confidence", None)}


#: blank, or a key with a scalar or nothing behind it; no lists, flow collections, anchors, tags, block texts or escapes
LINE = re.compile(r"""(?:---)?\s*(?:\#.*)?$|(?P<indent>\ *)(?P<key>[\w.-]+|"[^"\\]*"|'[^']*')\ *:(?:\ +(?P<value>"[^"\\]*"|'[^']*'|[^\s"'\[{&*!|>%@`#-][^#]*?|-?[\d.][^#]*?))?(?:\s+\#.*)?\s*$""", re.X)


def read_yaml(path: str | Path) -> dict:
    """A YAML file of nested mappings and plain or quoted scalars; {} if there is none. Anything else is an error."""
    path = Path(path)
    if not path.exists():
        return {}
    out: dict = {}
    stack: list[tuple[int, dict]] = [(-1, out)]
    for line in path.read_text("utf-8").splitlines():
        found = LINE.match(line)
        if not found:
            raise ValueError(f"{path}: not a mapping of scalars: {line!r}")
        if found["key"] is None:
            continue
        depth, key, value = len(found["indent"]), found["key"].strip("\"'"), found["value"] or ""
        while stack[-1][0] >= depth:
            stack.pop()
        if value.strip():
            stack[-1][1][key] = value[1:-1] if value[0] in "\"'" else _scalar(value.strip())
        else:
            stack[-1][1][key] = new = {}
            stack.append((depth, new))
    return out


def _scalar(x: str):
    if x.lower() in ("true", "false", "null", "~"):
        return {"true": True, "false": False}.get(x.lower())
    for kind in (int, float):
        try:
            return kind(x)
        except ValueError:
            pass
    return x


def load_thresholds(path: str | Path) -> Thresholds:
    raw, found = read_yaml(path), {}
    for name, (section, key) in _PLACES.items():
        value = raw.get(section) if key is None else (raw.get(section) or {}).get(key)
        if value is not None:
            found[name] = value
    return Thresholds(**found)


def load_flags(path: str | Path) -> Flags:
    names = {f.name for f in fields(Flags)}
    return Flags(**{k: v for k, v in read_yaml(path).items() if k in names})
