"""Small settings files, read on the driver: strict TOML sections and polygon regions in YAML."""

from __future__ import annotations

import dataclasses
import math
import re
import tomllib


def sections(text: str, schemas: dict[str, type]) -> dict[str, object]:
    """Each section of a TOML text as an instance of its dataclass; missing or unknown sections and keys are errors."""
    raw = tomllib.loads(text)
    _same(raw, set(schemas), set(schemas), "sections")
    out = {}
    for name, schema in schemas.items():
        if not isinstance(raw[name], dict):
            raise ValueError(f"[{name}] is no table")
        declared = dataclasses.fields(schema)
        needed = {f.name for f in declared if f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING}
        _same(raw[name], needed, {f.name for f in declared}, f"keys of [{name}]")
        out[name] = schema(**raw[name])
    return out


def _same(found, needed: set, known: set, what: str) -> None:
    missing, unknown = sorted(needed - set(found)), sorted(set(found) - known)
    if missing or unknown:
        raise ValueError(f"{what}: missing {missing}, unknown {unknown}")


def path_below(root: str, value: object) -> str:
    """A path of the settings: below the root unless it is absolute or a URI."""
    if not isinstance(value, str) or not value.strip():
        raise ValueError("a path must be a text that isn't empty")
    return value if value.startswith("/") or "://" in value else f"{root.rstrip('/')}/{value}"


@dataclasses.dataclass(frozen=True)
class Region:
    resolution: float
    origin: tuple[float, float]
    polygon: tuple[tuple[float, float], ...]

    def __post_init__(self):
        if self.resolution <= 0:
            raise ValueError("the resolution must be positive")
        if len(self.polygon) < 3 or abs(area(self.polygon)) <= 1e-9:
            raise ValueError("the polygon needs three points and an area")


def area(polygon) -> float:
    """Signed area by the shoelace formula."""
    return sum(x * v - u * z for (x, z), (u, v) in zip(polygon, [*polygon[1:], polygon[0]], strict=True)) / 2


def dump_region(region: Region) -> str:
    """YAML with the keys resolution, origin and polygon, in this order."""
    lines = [f"resolution: {region.resolution!r}", "origin:", *[f"- {v!r}" for v in region.origin], "polygon:"]
    for x, z in region.polygon:
        lines += [f"- - {x!r}", f"  - {z!r}"]
    return "\n".join(lines) + "\n"


def load_region(text: str) -> Region:
    """A region from YAML: exactly three keys, finite numbers, pairs as block or flow lists. Other YAML is refused."""
    raw = _mapping(text)
    _same(raw, known := {"resolution", "origin", "polygon"}, known, "region")
    return Region(_number(raw["resolution"]), _pair(raw["origin"]), tuple(map(_pair, _list(raw["polygon"]))))


def _number(value: object) -> float:
    if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value):
        raise ValueError(f"{value!r} is no finite number")
    return float(value)


def _list(value: object) -> list:
    if not isinstance(value, list):
        raise ValueError(f"{value!r} is no list")
    return value


def _pair(value: object) -> tuple[float, float]:
    if len(_list(value)) != 2:
        raise ValueError(f"{value!r} is no pair")
    return _number(value[0]), _number(value[1])


_KEY, _SPACES = re.compile(r"([A-Za-z_]+):(?:\s+(.*))?$"), re.compile(r"\s+#.*$")


def _mapping(text: str) -> dict[str, object]:
    """Top-level keys with a number, a flow list, or a block list of numbers or pairs."""
    out: dict[str, object] = {}
    blocks: list | None = None
    for full in text.splitlines():
        line = _SPACES.sub("", full).rstrip()
        if not line or line.startswith("#"):
            continue
        if m := _KEY.match(line):
            key, value = m.groups()
            if key in out:
                raise ValueError(f"{key} is there twice")
            blocks = [] if not value else None
            out[key] = blocks if blocks is not None else _value(value)
            continue
        item = line.strip()
        if blocks is None or not item.startswith("-"):
            raise ValueError(f"unexpected line {full!r}")
        if item.startswith("- - "):
            blocks.append([_value(item[3:].strip())])
        elif line.startswith((" ", "\t")) and blocks and isinstance(blocks[-1], list):
            blocks[-1].append(_value(item[1:].strip()))
        else:
            blocks.append(_value(item[1:].strip()))
    return out


def _value(text: str) -> object:
    if text.startswith("["):
        if not text.endswith("]"):
            raise ValueError(f"{text!r} isn't closed")
        inner, depth, parts, at = text[1:-1], 0, [], 0
        for k, ch in enumerate(inner):
            depth += (ch == "[") - (ch == "]")
            if ch == "," and not depth:
                parts.append(inner[at:k])
                at = k + 1
        return [_value(p.strip()) for p in [*parts, inner[at:]] if p.strip()]
    try:
        return int(text) if re.fullmatch(r"[-+]?\d+", text) else float(text)
    except ValueError:
        return text
