"""Subject profiles: what a domain adds to the pipeline, as a YAML mapping."""

from __future__ import annotations

from pathlib import Path

import pydantic
import yaml

from chalkline.errors import ProfileError

PROFILES = Path(__file__).resolve().parent / "resources" / "profiles"


class Verification(pydantic.BaseModel):
    """How to check extracted code; ``{file}`` stands for the snippet's file."""

    kind: str
    command: str


class Profile(pydantic.BaseModel):
    """Unknown keys are errors. Mask regions are fractions (x0, y0, x1, y1) of a frame that its hash leaves out."""

    model_config = pydantic.ConfigDict(extra="forbid")

    name: str
    description: str = ""
    vocabulary: list[str] = []
    code_languages: list[str] = []
    asr_language: str | None = None
    concept_id_prefix: str = "gen"
    verification: Verification | None = None
    distill_hints: str = ""
    keyframe_mask_regions: list[tuple[float, float, float, float]] = []

    def recogniser_prompt(self) -> str | None:
        """A sentence that tells a speech recogniser what words to expect; None without a vocabulary."""
        if not self.vocabulary:
            return None
        return f"The following is a transcript about {self.description or self.name}. Expect terminology such as: {', '.join(self.vocabulary)}."


def available(folder: Path | None = None) -> list[str]:
    return sorted(p.stem for p in (folder or PROFILES).glob("*.yaml"))


def load(name: str, folder: Path | None = None) -> Profile:
    path = (folder or PROFILES) / f"{name}.yaml"
    if not path.is_file():
        raise ProfileError(f"no profile {name!r} at {path}; there are: {', '.join(available(folder)) or 'none'}")
    try:
        found = yaml.safe_load(path.read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise ProfileError(f"profile {name!r} is not valid YAML: {error}") from error
    if not isinstance(found, dict):
        raise ProfileError(f"profile {name!r} must be a mapping, not {type(found).__name__}")
    try:
        return Profile.model_validate(found)
    except pydantic.ValidationError as error:
        raise ProfileError(f"profile {name!r} is not valid: {error}") from error
