"""The boundary to models: text, vision, embeddings and speech.

A provider runs on executors, so it must pickle; clients of hosted services are made on first use.
``Offline`` answers without a network by fixed rules and serves tests and dry runs.
"""

from __future__ import annotations

import base64
import hashlib
import json
import mimetypes
import re
from dataclasses import dataclass
from typing import Protocol

from chalkline.errors import DependencyMissing, ProviderError


@dataclass(frozen=True)
class Word:
    start: float
    end: float
    text: str
    probability: float | None = None


@dataclass(frozen=True)
class Segment:
    start: float
    end: float
    text: str
    words: tuple[Word, ...] = ()


@dataclass(frozen=True)
class Speech:
    language: str
    segments: tuple[Segment, ...] = ()


@dataclass(frozen=True)
class Message:
    role: str
    content: str


#: A text, or the messages of a conversation.
Prompt = str | list[Message]


def text_of(prompt: Prompt) -> str:
    """All that a prompt says."""
    return prompt if isinstance(prompt, str) else "\n\n".join(m.content for m in prompt)


class Provider(Protocol):
    """``max_tokens`` bounds a reply; None leaves that to the model."""

    def complete(self, prompt: Prompt, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str: ...

    def vision(self, prompt: str, image: bytes, mime: str, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str: ...

    def embed(self, texts: list[str], *, model: str) -> list[list[float]]: ...

    def transcribe(self, audio: bytes, name: str, *, model: str, prompt: str | None = None, language: str | None = None) -> Speech: ...


class Offline:
    """Fixed rules: a note is the first words said, a frame is an empty slide, a vector counts hashed words."""

    def __init__(self, dimension: int = 64) -> None:
        self.dimension = dimension

    def complete(self, prompt: Prompt, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str:
        prompt = text_of(prompt)
        if "SUMMARY:" in prompt:
            source, _, summary = prompt.partition("SUMMARY:")
            known = set(re.findall(r"\w+", source.lower()))
            return json.dumps({"supported": all(w in known for w in re.findall(r"\w+", summary.lower()))})
        said = prompt.partition("TRANSCRIPT:\n")[2].partition("\n\nON SCREEN:")[0]
        words = said.split()
        return json.dumps({"skip": not words or said == "(none)", "concept": " ".join(words[:3]), "summary": " ".join(words[:40]), "pitfalls": [], "depends_on": [], "partial": False})

    def vision(self, prompt: str, image: bytes, mime: str, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str:
        return json.dumps({"kind": "other", "text": "", "description": f"{len(image)} bytes of {mime}"})

    def embed(self, texts: list[str], *, model: str) -> list[list[float]]:
        out = []
        for text in texts:
            vector = [0.0] * self.dimension
            for word in re.findall(r"\w+", text.lower()):
                vector[int(hashlib.sha256(word.encode()).hexdigest()[:8], 16) % self.dimension] += 1.0
            out.append(vector)
        return out

    def transcribe(self, audio: bytes, name: str, *, model: str, prompt: str | None = None, language: str | None = None) -> Speech:
        return Speech(language or "unknown")


class Routed:
    """Pictures to one provider, all else to another."""

    def __init__(self, default: Provider, vision: Provider | None = None) -> None:
        self.default, self.seeing = default, vision or default

    def complete(self, prompt: Prompt, **options) -> str:
        return self.default.complete(prompt, **options)

    def vision(self, prompt: str, image: bytes, mime: str, **options) -> str:
        return self.seeing.vision(prompt, image, mime, **options)

    def embed(self, texts: list[str], **options) -> list[list[float]]:
        return self.default.embed(texts, **options)

    def transcribe(self, audio: bytes, name: str, **options) -> Speech:
        return self.default.transcribe(audio, name, **options)


def mime_type(name: str) -> str:
    return mimetypes.guess_type(name)[0] or "image/jpeg"


def data_url(image: bytes, mime: str) -> str:
    return f"data:{mime};base64,{base64.b64encode(image).decode()}"


class _Hosted:
    """Makes its client when first used, on the machine that uses it."""

    def __init__(self, api_key: str | None) -> None:
        if not api_key:
            raise ProviderError(f"{type(self).__name__} needs an API key")
        self.api_key = api_key
        self._client = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_client": None}

    def client(self):
        if self._client is None:
            self._client = self._connect()
        return self._client


class OpenAI(_Hosted):
    """Text, vision, embeddings and speech of the hosted service, through its package. Not exercised by tests: there is no network."""

    def _connect(self):
        try:
            import openai
        except ImportError as error:
            raise DependencyMissing("install the package openai") from error
        return openai.OpenAI(api_key=self.api_key, max_retries=6, timeout=120.0)

    def _chat(self, messages: list[dict], model: str, temperature: float, max_tokens: int | None) -> str:
        bound = {} if max_tokens is None else {"max_tokens": max_tokens}
        try:
            reply = self.client().chat.completions.create(model=model, temperature=temperature, messages=messages, **bound)
        except Exception as error:
            raise ProviderError(str(error)) from error
        return reply.choices[0].message.content or ""

    def complete(self, prompt: Prompt, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str:
        told = [Message("user", prompt)] if isinstance(prompt, str) else prompt
        return self._chat([{"role": m.role, "content": m.content} for m in told], model, temperature, max_tokens)

    def vision(self, prompt: str, image: bytes, mime: str, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str:
        parts = [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": {"url": data_url(image, mime)}}]
        return self._chat([{"role": "user", "content": parts}], model, temperature, max_tokens)

    def embed(self, texts: list[str], *, model: str) -> list[list[float]]:
        return [row.embedding for row in self.client().embeddings.create(model=model, input=texts).data]

    def transcribe(self, audio: bytes, name: str, *, model: str, prompt: str | None = None, language: str | None = None) -> Speech:
        options = {k: v for k, v in (("prompt", prompt), ("language", language)) if v}
        reply = self.client().audio.transcriptions.create(model=model, file=(name, audio), response_format="verbose_json", timestamp_granularities=["segment"], **options)
        return Speech(reply.language or "unknown", tuple(Segment(s.start, s.end, s.text) for s in reply.segments or ()))


class Gemini(_Hosted):
    """Vision alone. Not exercised by tests: there is no network."""

    def _connect(self):
        try:
            from google import genai
        except ImportError as error:
            raise DependencyMissing("install the package google-genai") from error
        return genai.Client(api_key=self.api_key, http_options={"timeout": 60_000})

    def vision(self, prompt: str, image: bytes, mime: str, *, model: str, temperature: float = 0.2, max_tokens: int | None = None) -> str:
        from google.genai import types

        try:
            reply = self.client().models.generate_content(model=model, contents=[types.Part.from_bytes(data=image, mime_type=mime), prompt],
                                                          config=types.GenerateContentConfig(temperature=temperature, max_output_tokens=max_tokens, thinking_config=types.ThinkingConfig(thinking_budget=0)))
        except Exception as error:
            raise ProviderError(str(error)) from error
        return reply.text or ""

    def _other(self, *_, **__):
        raise ProviderError("this provider serves vision only")

    complete = embed = transcribe = _other
