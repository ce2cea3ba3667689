"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def optional_int(value: str) -> int | None:
    """A number, or None for 0, nothing, none or off."""
    text = value.strip().lower()
    return None if text in ("", "0", "none", "off") else int(text)


@dataclass(frozen=True)
class Config:
    openai_api_key: str | None = None
    gemini_api_key: str | None = None
    vision_provider: str = "openai"
    asr_model: str = "small"
    vision_model: str = "gpt-4o"
    distill_model: str = "gpt-4o-mini"
    embed_model: str = "text-embedding-3-small"
    vision_max_width: int | None = 1024
    cache_dir: str = ".cache"
    kb_dir: str = ".kb"
    vector_store: str = "parquet"


def load(env: Mapping[str, str] | None = None) -> Config:
    """``CHALKLINE_*`` variables, and the keys by their usual names; the vision model's default follows its provider."""
    env = os.environ if env is None else env
    own = lambda name, default: env.get(f"CHALKLINE_{name}", default)
    vision = own("VISION_PROVIDER", "openai").lower()
    return Config(
        openai_api_key=env.get("OPENAI_API_KEY"), gemini_api_key=env.get("GEMINI_API_KEY"), vision_provider=vision, asr_model=own("ASR_MODEL", "small"),
        vision_model=own("VISION_MODEL", "gemini-3.1-flash-lite" if vision == "gemini" else "gpt-4o"), distill_model=own("DISTILL_MODEL", "gpt-4o-mini"),
        embed_model=own("EMBED_MODEL", "text-embedding-3-small"), vision_max_width=optional_int(own("VISION_MAX_WIDTH", "1024")),
        cache_dir=own("CACHE_DIR", ".cache"), kb_dir=own("KB_DIR", ".kb"), vector_store=own("VECTOR_STORE", "parquet").lower())
