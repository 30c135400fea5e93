"""Model providers over HTTP by the standard library alone; any object with name and call(prompt) will do instead."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from .settings import ConfigurationError

# Addresses of services with the common chat-completions interface, and the key that local ones take.
PRESETS = {
    "ollama": ("http://localhost:11434/v1", "ollama"),
    "lmstudio": ("http://localhost:1234/v1", "lm-studio"),
    "vllm": ("http://localhost:8000/v1", "vllm"),
    "megallm": ("https://ai.megallm.io/v1", None),
    "together": ("https://api.together.xyz/v1", None),
    "groq": ("https://api.groq.com/openai/v1", None),
    "fireworks": ("https://api.fireworks.ai/inference/v1", None),
    "deepseek": ("https://api.deepseek.com/v1", None),
    "openrouter": ("https://openrouter.ai/api/v1", None),
    "nvidia": ("https://integrate.api.nvidia.com/v1", None),
    "perplexity": ("https://api.perplexity.ai", None),
}


def post(url: str, body: dict, head: dict, timeout: float) -> Any:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"} | head)
    with urllib.request.urlopen(request, timeout=timeout) as got:  # noqa: S310
        return json.load(got)


@dataclass
class HttpProvider:
    """Any service with the common chat-completions interface."""

    name: str
    base_url: str
    api_key: str | None = None
    model: str = ""
    temperature: float = 0.7
    max_tokens: int = 4096
    timeout: float = 120
    send: Callable[[str, dict, dict, float], Any] = field(default=post, repr=False)

    def __post_init__(self):
        self.base_url = self.base_url.rstrip("/")

    def call(self, prompt: str) -> str | None:
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": self.temperature, "max_tokens": self.max_tokens}
        head = {"Authorization": f"Bearer {self.api_key}"} if self.api_key else {}
        return self.send(f"{self.base_url}/chat/completions", body, head, self.timeout)["choices"][0]["message"]["content"]


class MessagesProvider(HttpProvider):
    """The messages interface: a version header, and no sampling parameters."""

    def call(self, prompt: str) -> str | None:
        body = {"model": self.model, "max_tokens": self.max_tokens, "messages": [{"role": "user", "content": prompt}]}
        got = self.send(f"{self.base_url}/messages", body, {"x-api-key": self.api_key or "", "anthropic-version": "2023-06-01"}, self.timeout)
        return "".join(part.get("text", "") for part in got["content"])


class ContentProvider(HttpProvider):
    """The generateContent interface."""

    def call(self, prompt: str) -> str | None:
        body = {"contents": [{"parts": [{"text": prompt}]}], "generationConfig": {"temperature": self.temperature, "maxOutputTokens": self.max_tokens}}
        got = self.send(f"{self.base_url}/models/{self.model}:generateContent", body, {"x-goog-api-key": self.api_key or ""}, self.timeout)
        return "".join(part.get("text", "") for part in got["candidates"][0]["content"]["parts"])


PROVIDERS: dict[str, tuple[type[HttpProvider], str | None]] = {
    "openai": (HttpProvider, "https://api.openai.com/v1"),
    "anthropic": (MessagesProvider, "https://api.anthropic.com/v1"),
    "gemini": (ContentProvider, "https://generativelanguage.googleapis.com/v1beta"),
    "custom": (HttpProvider, None),
}


def register_provider(name: str, kind: type[HttpProvider], base_url: str | None = None) -> None:
    PROVIDERS[name] = (kind, base_url)


def make_provider(name: str, own: dict) -> HttpProvider:
    """A registered kind, a preset, or any service with a base_url."""
    kind, url = PROVIDERS.get(name, (HttpProvider, None))
    preset, key = PRESETS.get(name, (None, None))
    url = own.get("base_url") or url or preset
    if not url:
        raise ConfigurationError(f"provider {name!r} needs a base_url")
    return kind(name, url, own.get("api_key") or key, own.get("model", ""), own.get("temperature", 0.7), own.get("max_tokens", 4096))


def make_providers(own: dict) -> list[HttpProvider]:
    """One for each key of a provider's settings."""
    keys = own.get("api_keys") or [own.get("api_key")]
    return [make_provider(own["name"], own | {"api_key": k}) for k in keys]


def available_providers() -> list[str]:
    return sorted({*PROVIDERS, *PRESETS})
