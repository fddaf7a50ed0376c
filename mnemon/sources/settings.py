"""Command-line arguments, .env files, configuration and the project catalogue."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

_TRUE, _FALSE = {"1", "true", "yes", "y", "on"}, {"0", "false", "no", "n", "off"}


def parse_args(argv: list[str]) -> dict[str, str | bool]:
    """``--k=v``, ``--k v`` and ``--flag``; what stands after a second '=' is dropped."""
    out: dict[str, str | bool] = {}
    i = 0
    while i < len(argv):
        if argv[i].startswith("--"):
            name, *value = argv[i][2:].split("=")
            if value:
                out[name] = value[0]
            elif i + 1 < len(argv) and not argv[i + 1].startswith("--"):
                i += 1
                out[name] = argv[i]
            else:
                out[name] = True
        i += 1
    return out


def read_env_file(path: str) -> dict[str, str]:
    """Name=value lines; blank lines, comments and lines without '=' are skipped, a missing file is empty."""
    out: dict[str, str] = {}
    try:
        with open(path, encoding="utf-8") as f:
            for line in f:
                line = line.strip()
                if line and not line.startswith("#") and "=" in line:
                    name, value = line.split("=", 1)
                    out[name.strip()] = value.strip()
    except FileNotFoundError:
        pass
    return out


def to_bool(value: object, default: bool = False) -> bool:
    if isinstance(value, bool):
        return value
    word = str(value).strip().lower() if value is not None else ""
    return True if word in _TRUE else False if word in _FALSE else default


def to_positive(value: object) -> int | None:
    try:
        number = int(float(str(value)))
    except (TypeError, ValueError):
        return None
    return number if number > 0 else None


@dataclass
class Settings:
    """What a nightly run needs."""

    sessions: str = ""
    memory_root: str = ""
    out: str = ""
    date: str = "yesterday"
    time_zone: str = "Asia/Seoul"
    limit: int | None = None
    scorer: str = "heuristic"
    write_promotions: bool = False
    purge_plan: bool = True
    dry_run: bool = True
    provider: str = "local"
    model: str = "stub-v1"
    scorer_url: str = ""
    scorer_key: str = ""
    embed_url: str = ""
    known_projects: list[dict] = field(default_factory=list)

    @classmethod
    def load(cls, argv: list[str], env: dict[str, str] | None = None, env_file: str | None = None) -> Settings:
        """Arguments, then the environment, then the .env file, then defaults."""
        args, env = parse_args(argv), dict(os.environ) if env is None else env
        env_file = env_file or str(args.get("env-file") or ".env")
        kept = read_env_file(env_file)

        def pick(name: str, default: object) -> object:
            variable = "MNEMON_" + name.upper().replace("-", "_")
            for source, key in ((args, name), (env, variable), (kept, variable)):
                if source.get(key) not in (None, ""):
                    return source[key]
            return default

        base = cls()
        text = lambda name, value: str(pick(name, value))
        root = text("memory-root", base.memory_root)
        return cls(
            text("sessions", base.sessions), root, text("out", base.out), text("date", base.date), text("time-zone", base.time_zone), to_positive(pick("limit", None)),
            "llm" if text("scorer", base.scorer) == "llm" else "heuristic", to_bool(pick("write-promotions", None), base.write_promotions),
            to_bool(pick("purge-plan", None), base.purge_plan), to_bool(pick("dry-run", None), base.dry_run), text("provider", base.provider), text("model", base.model),
            text("scorer-url", base.scorer_url), text("scorer-key", base.scorer_key), text("embed-url", base.embed_url),
            known_projects(root) if root else [],
        )


def project_aliases(name: str) -> list[str]:
    low = name.lower()
    bare = re.sub(r"^\d{2}_", "", low)
    return list(dict.fromkeys(x for x in (low, low.replace("_", "-"), bare, bare.replace("_", "-")) if x))


def known_projects(folder: str) -> list[dict]:
    """The numbered directories below ``folder`` (such as ``07_name``), as catalogue entries."""
    if not os.path.isdir(folder):
        return []
    names = sorted(n for n in os.listdir(folder) if re.fullmatch(r"(?i)\d{2}_[a-z0-9][a-z0-9_-]*", n) and os.path.isdir(os.path.join(folder, n)))
    return [{"slug": n.lower(), "name": n, "aliases": project_aliases(n)} for n in names]
