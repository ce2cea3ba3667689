"""Replies of models, checked against their schemas. Pure Python, for the model boundary."""

from __future__ import annotations

import json
import re
from typing import Literal

import pydantic

NOTE_REPLY = "struct<skip:boolean,concept:string,summary:string,pitfalls:array<string>,depends_on:array<string>,partial:boolean>"
VISUAL_REPLY = "struct<kind:string,text:string,code_language:string,description:string,diagram:string>"


class NoteReply(pydantic.BaseModel):
    skip: bool = False
    concept: str = ""
    summary: str = ""
    pitfalls: list[str] = []
    depends_on: list[str] = []
    partial: bool = False


class VisualReply(pydantic.BaseModel):
    kind: Literal["slide", "code", "whiteboard", "other"]
    text: str
    code_language: str | None = None
    description: str = ""
    diagram: str = ""


class UnusableReply(ValueError):
    """Its message tells a model what was wrong."""


#: A fence's first line, what it holds, and the fence that ends it, if any.
_FENCED = re.compile(r"```[^\n]*(?:\n(?P<held>.*?))??(?:(?:^|\n)[^\S\n]*```)?", re.DOTALL)


def strip_fence(raw: str) -> str:
    """A reply without the code fence around it."""
    text = "\n".join(raw.strip().splitlines())
    fenced = _FENCED.fullmatch(text)
    return (fenced["held"] or "").strip() if fenced else raw.strip()


def json_object(raw: str) -> dict:
    try:
        found = json.loads(strip_fence(raw))
    except json.JSONDecodeError as error:
        raise UnusableReply(f"not valid JSON ({error})") from error
    if not isinstance(found, dict):
        raise UnusableReply("not a JSON object")
    return found


def _checked(kind: type[pydantic.BaseModel], raw: str) -> dict:
    try:
        return kind.model_validate(json_object(raw)).model_dump()
    except pydantic.ValidationError as error:
        raise UnusableReply(f"{error.error_count()} fields do not fit the schema") from error


def parse_note(raw: str) -> dict:
    return _checked(NoteReply, raw)


def parse_visual(raw: str) -> dict:
    return _checked(VisualReply, raw)


def parse_verdict(raw: str) -> bool:
    """Whether a judge says supported; what cannot be read is not."""
    try:
        return bool(json_object(raw).get("supported", False))
    except UnusableReply:
        return False
