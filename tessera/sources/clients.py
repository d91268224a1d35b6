"""Providers that annotate images, and what each needs before it can be asked.

A provider is a list of needs in order: the first that isn't met is the reason
of a failed answer. Needs are looked at where a request runs, since keys and
packages are those of the executor.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module
from pathlib import Path

#: Kinds of images that can be sent, by the ending of their names.
MIME = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp", "bmp": "image/bmp"}
#: Words that switch a setting on or off.
ON, OFF = ("1", "true", "yes", "on"), ("0", "false", "no", "off")


class Unavailable(Exception):
    """A provider can't answer; the text says why and is the whole error."""


def setting(config: dict, key: str, kind: type, default=None):
    """A setting of a kind; the default where it is missing, blank or of no use."""
    value = config.get(key)
    if kind is bool:
        word = str(value).strip().lower()
        return True if word in ON else False if word in OFF else default
    if value is None or kind is str and not str(value).strip():
        return default
    try:
        return str(value).strip() if kind is str else kind(value)
    except (TypeError, ValueError, OverflowError):
        return default


@dataclass(frozen=True)
class Need:
    met: Callable[[dict], bool]
    reason: Callable[[dict], str]


def key_from(*names: str) -> Need:
    """An API key in the first of these environment variables that has one."""
    return Need(lambda _: any(os.getenv(n) for n in names), lambda _: f"Missing API key: set {' or '.join(names)}")


def package(name: str, reason: str) -> Need:
    def there(_: dict) -> bool:
        try:
            import_module(name)
        except ImportError:
            return False
        return True

    return Need(there, lambda _: reason)


def configured(key: str) -> Need:
    return Need(lambda c: bool(setting(c, key, str)), lambda _: f"Missing {key} in model config")


def unfinished(label: str) -> Need:
    return Need(lambda _: False, lambda _: f"{label} real API call is not fully implemented yet")


def stub(label: str, sdk: str, *keys: str) -> tuple[Need, ...]:
    """A provider whose calls aren't there: it says what it lacks first."""
    return key_from(*keys), package(sdk, f"{label} SDK is not installed. {label} real API call is not fully implemented yet"), unfinished(label)


_DASHSCOPE = stub("DashScope", "dashscope", "DASHSCOPE_API_KEY", "QWEN_API_KEY")
NEEDS: dict[str, tuple[Need, ...]] = {
    "mock": (),
    "dashscope": _DASHSCOPE,
    "qwen": _DASHSCOPE,
    "openai": stub("OpenAI", "openai", "OPENAI_API_KEY"),
    "anthropic": stub("Anthropic", "anthropic", "ANTHROPIC_API_KEY"),
    "gemini": stub("Gemini", "google.generativeai", "GEMINI_API_KEY"),
    "openai_compatible": (
        Need(lambda c: setting(c, "supports_vision", bool, True), lambda _: "Model config does not support vision input"),
        configured("base_url"),
        configured("api_key_env"),
        Need(lambda c: bool(os.getenv(c["api_key_env"].strip())), lambda c: f"Missing API key: set {c['api_key_env'].strip()}"),
        package("openai", 'OpenAI SDK is not installed. Install it with: uv pip install -e ".[api]"'),
    ),
}


def lacking(config: dict) -> str | None:
    """Why a model's provider can't answer, or None."""
    for need in NEEDS[str(config.get("provider", "")).strip().lower()]:
        if not need.met(config):
            return need.reason(config)
    return None


def image_url(path: str, content: bytes | None = None) -> str:
    """An image as a data URL; only kinds that can be sent."""
    suffix = Path(path).suffix.lower()
    mime = MIME.get(suffix[1:])
    if mime is None:
        raise ValueError(f"Unsupported image suffix for OpenAI-compatible client: {suffix}")
    data = Path(path.removeprefix("file://").removeprefix("file:")).read_bytes() if content is None else content
    return f"data:{mime};base64,{base64.b64encode(data).decode()}"


def chat(config: dict, path: str, prompt: str) -> str:
    """One call of an OpenAI-compatible service, for which all needs are met."""
    made = import_module("openai").OpenAI(api_key=os.environ[setting(config, "api_key_env", str)],
        base_url=setting(config, "base_url", str), timeout=setting(config, "timeout", int, 120))
    parts = [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": {"url": image_url(path)}}]
    said = made.chat.completions.create(model=setting(config, "name", str), messages=[{"role": "user", "content": parts}],
        max_tokens=setting(config, "max_tokens", int, 4096), temperature=setting(config, "temperature", float, 0.0))
    return str(said.choices[0].message.content)


def answer(config: dict, path: str, prompt: str) -> str:
    """What a model says of an image. Mock models are answered by tasks.mock_answers()."""
    if why := lacking(config):
        raise Unavailable(why)
    if config["provider"].strip().lower() != "openai_compatible":
        raise Unavailable(f"{config['provider']} has no calls here")
    return chat(config, path, prompt)
