"""Settings from the environment, and logging. Importing this has no side effects."""

from __future__ import annotations

import json
import logging
import os
from dataclasses import dataclass, fields
from datetime import datetime, timezone


@dataclass(frozen=True)
class Settings:
    """Each field is read from INNKEEP_<FIELD>."""

    output_dir: str = "out"
    log_level: str = "INFO"
    log_file: str = ""  # errors also go there, as JSON lines
    room_threshold: float = 0.80  # of matching, where the variable is set; else the method's own
    batch_size: int = 32  # texts that are embedded at once

    @classmethod
    def from_env(cls, env=os.environ) -> Settings:
        return cls(**{f.name: type(f.default)(env[key]) for f in fields(cls) if (key := f"INNKEEP_{f.name.upper()}") in env})


class JSONFormatter(logging.Formatter):
    """A record as one line of JSON."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"timestamp": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["exception"] = self.formatException(record.exc_info)
        return json.dumps(out)


def logger(settings: Settings | None = None, name: str = "innkeep") -> logging.Logger:
    """The library's logger: messages to the console, errors also to the log file."""
    s = settings or Settings.from_env()
    log = logging.getLogger(name)
    log.setLevel(s.log_level)
    if not any(isinstance(h, logging.StreamHandler) and not isinstance(h, logging.FileHandler) for h in log.handlers):
        console = logging.StreamHandler()
        console.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(console)
    if s.log_file and not any(isinstance(h, logging.FileHandler) and h.baseFilename == os.path.abspath(s.log_file) for h in log.handlers):
        errors = logging.FileHandler(s.log_file)
        errors.setLevel(logging.ERROR)
        errors.setFormatter(JSONFormatter())
        log.addHandler(errors)
    return log


def device() -> str:
    """Where a local embedding model would run: cuda if a usable torch says so, else cpu."""
    try:
        import torch
    except ImportError:
        return "cpu"
    return "cuda" if torch.cuda.is_available() else "cpu"
