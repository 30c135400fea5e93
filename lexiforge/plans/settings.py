"""Settings of a run: a YAML tree, its defaults, and what is wrong with it."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Any

from ..functions import fixed as X


class PipelineError(Exception):
    """category: config, validation, api, rate_limit, auth, network, io, parse or internal; severity: warning, error or critical."""

    category, severity, recoverable = "internal", "error", True

    def __init__(self, message: str, **details: Any):
        super().__init__(message)
        self.message, self.details = message, {k: str(v) for k, v in details.items() if v is not None}

    def record(self) -> dict:
        return {"error_type": type(self).__name__, "message": self.message, "category": self.category, "severity": self.severity, "recoverable": self.recoverable, "details": self.details}

    def __str__(self) -> str:
        return f"[{self.category.upper()}] {self.message}"


def _kind(name: str, category: str, severity: str = "error", recoverable: bool = True) -> type[PipelineError]:
    return type(name, (PipelineError,), {"category": category, "severity": severity, "recoverable": recoverable})


ConfigurationError = _kind("ConfigurationError", "config", "critical", False)
ValidationError = _kind("ValidationError", "validation")
APIError = _kind("APIError", "api")
RateLimitError = _kind("RateLimitError", "rate_limit", "warning")
AuthenticationError = _kind("AuthenticationError", "auth", "critical", False)
NetworkError = _kind("NetworkError", "network")
FileError = _kind("FileError", "io")
ParseError = _kind("ParseError", "parse", "warning")


@dataclass
class Finding:
    field: str
    message: str
    severity: str = "error"
    value: Any = None
    suggestion: str | None = None


@dataclass
class Findings:
    items: list[Finding] = field(default_factory=list)

    def add(self, bad: bool, name: str, message: str, severity: str = "error", **more: Any) -> bool:
        if bad:
            self.items.append(Finding(name, message, severity, **more))
        return bad

    @property
    def errors(self) -> list[Finding]:
        return [f for f in self.items if f.severity == "error"]

    @property
    def warnings(self) -> list[Finding]:
        return [f for f in self.items if f.severity != "error"]

    @property
    def is_valid(self) -> bool:
        return not self.errors

    def messages(self, severity: str = "error") -> list[str]:
        return [f"[{f.field}] {f.message}" for f in self.items if f.severity == severity]

    def merge(self, other: Findings) -> Findings:
        self.items += other.items
        return self


DEFAULTS: dict[str, Any] = {
    "general": {"input_dir": "input", "output_dir": "output"},
    "llm": {"provider": None, "providers": {}},
    "processing": {"chunk_size": 4000, "chunk_overlap": 200, "max_retries": 5, "max_threads": 20, "threads_per_key": 5, "requests_per_minute": 60},
    "qa_generation": {"num_qa": 5, "prompt_template": X.GENERATE_PROMPT, "perspectives": []},
    "quality": {"min_score": 3, "criteria": [], "mode": "rule", "max_iterations": 3, "prompt_template": X.JUDGE_PROMPT},
    "regenerate": {"min_good_rate": 0.5, "min_good_count": 1},
    "filter": {"enabled": True},
    "output": {"train_ratio": 0.70, "val_ratio": 0.15, "test_ratio": 0.15, "seed": 42, "formats": ["json", "jsonl"], "structure": {}},
    "cache": {"enabled": True, "ttl_days": 30},
}
LOCAL = ("ollama", "lmstudio", "vllm")


class Settings:
    """tree over DEFAULTS; get("a.b.c", default) reads it by a dotted path."""

    def __init__(self, tree: dict | None = None, base: str = "."):
        self.tree, self.base = _over(DEFAULTS, tree or {}), base

    @classmethod
    def load(cls, path: str | None = None) -> Settings:
        """From a YAML file: the given one, else the first of config.yaml and config.yml here."""
        import yaml

        found = path or next((p for p in ("config.yaml", "config.yml") if os.path.exists(p)), None)
        if not found or not os.path.exists(found):
            raise ConfigurationError("no configuration file", path=path)
        with open(found, encoding="utf-8") as f:
            return cls(yaml.safe_load(f) or {}, os.path.dirname(os.path.abspath(found)))

    def get(self, path: str, default: Any = None) -> Any:
        at: Any = self.tree
        for part in path.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at

    def resolved(self, path: str) -> str:
        p = self.get(path)
        return p if "://" in p or os.path.isabs(p) else os.path.join(self.base, p)

    def make_dirs(self) -> None:
        """Local input and output folders; those of other stores are made when they are written."""
        for name in ("general.input_dir", "general.output_dir"):
            if "://" not in (at := self.resolved(name)):
                os.makedirs(at, exist_ok=True)

    def perspectives(self) -> list[dict]:
        return [p for p in self.get("qa_generation.perspectives", []) if p.get("enabled", True)]

    def provider(self) -> dict:
        name = self.get("llm.provider")
        if not name or name not in self.get("llm.providers", {}):
            raise ConfigurationError(f"provider {name!r} is not configured")
        own = self.get("llm.providers")[name] | {"name": name}
        return own | {"api_keys": keys} if (keys := self.keys(own)) else own

    def keys(self, own: dict) -> list[str]:
        """All keys of a provider: listed ones and those of its file (a line each; blank ones and comments don't count)."""
        keys = list(own.get("api_keys") or ([own["api_key"]] if own.get("api_key") else []))
        if file := own.get("api_keys_file"):
            with open(file if os.path.isabs(file) else os.path.join(self.base, file), encoding="utf-8") as lines:
                keys += [x.strip() for x in lines if x.strip() and not x.strip().startswith("#")]
        return list(dict.fromkeys(keys))

    def calls(self, keys: int) -> dict[str, Any]:
        """How a run asks its providers: retries, its rate (calls a minute of the whole run) and its threads."""
        from ..operators.generate import Retries

        get = self.get
        threads = max(1, min(get("processing.max_threads") or 1, get("processing.threads_per_key") * max(1, keys)))
        return {"retries": Retries(get("processing.max_retries")), "rpm": get("processing.requests_per_minute"), "threads": threads}

    def score_rules(self):
        """The pipeline's thresholds: twice the minimum of 1 to 5, and the third criterion's length."""
        from ..operators.score import ScoreRules

        criteria = self.get("quality.criteria", [])
        least = criteria[2].get("min_chars", 100) if len(criteria) > 2 else 100
        return ScoreRules(min_score=2.0 * self.get("quality.min_score"), min_answer=least)

    def check(self) -> Findings:
        f = Findings()
        get, add = self.get, f.add
        size, overlap, retries, threads = (get(f"processing.{n}") for n in ("chunk_size", "chunk_overlap", "max_retries", "max_threads"))
        if not add(size <= 0, "processing.chunk_size", "must be above 0", value=size):
            add(size < 500, "processing.chunk_size", "so small that context may be lost", "warning", value=size)
            add(size > 10000, "processing.chunk_size", "may not fit the model's context", "warning", value=size)
        if not add(overlap < 0, "processing.chunk_overlap", "must not be negative", value=overlap):
            add(overlap >= size, "processing.chunk_overlap", "must be below chunk_size", value=overlap)
        if not add(retries <= 0, "processing.max_retries", "must be above 0", value=retries):
            add(retries > 20, "processing.max_retries", "slow when calls fail", "warning", value=retries)
        if not add(threads < 0, "processing.max_threads", "must not be negative", value=threads):
            add(threads > 100, "processing.max_threads", "may meet rate limits", "warning", value=threads)
        shares = {n: get(f"output.{n}") for n in ("train_ratio", "val_ratio", "test_ratio")}
        for n, v in shares.items():
            add(not 0 <= v <= 1, f"output.{n}", "must be from 0 to 1", value=v)
        add(abs(sum(shares.values()) - 1) > 0.01, "output.ratios", "must add up to 1", value=sum(shares.values()))
        least = get("quality.min_score")
        add(least < 1, "quality.min_score", "must be 1 or more", value=least)
        add(least > 5, "quality.min_score", "may drop too many pairs", "warning", value=least)
        return f.merge(self.check_provider()).merge(self.check_paths())

    def check_provider(self) -> Findings:
        f, name = Findings(), self.get("llm.provider")
        if f.add(not name, "llm.provider", "is missing"):
            return f
        own = self.get("llm.providers", {}).get(name)
        if f.add(not own, "llm.provider", f"{name} is not configured", value=name):
            return f
        local = name.lower() in LOCAL or "localhost" in (own.get("base_url") or "")
        keys = bool(own.get("api_key") or own.get("api_keys"))
        if file := own.get("api_keys_file"):
            file = file if os.path.isabs(file) else os.path.join(self.base, file)
            if not f.add(not os.path.exists(file), f"llm.providers.{name}.api_keys_file", "does not exist", value=file):
                with open(file, encoding="utf-8") as lines:
                    found = any(x.strip() and not x.startswith("#") for x in lines)
                f.add(not found, f"llm.providers.{name}.api_keys_file", "has no keys", "warning", value=file)
                keys = keys or found
        f.add(not keys and not local, f"llm.providers.{name}", "has no API key")
        return f

    def check_paths(self) -> Findings:
        f, at = Findings(), self.resolved("general.input_dir")
        f.add("://" not in at and not os.path.isdir(at), "general.input_dir", "does not exist", value=at)
        return f

    def require(self) -> Settings:
        f = self.check()
        if not f.is_valid:
            raise ConfigurationError("; ".join(f.messages()))
        return self


def _over(base: dict, own: dict) -> dict:
    out = dict(base)
    for k, v in own.items():
        out[k] = _over(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
