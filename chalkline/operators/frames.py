"""From key frames to what they show, behind the vision boundary and a cost limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chalkline.errors import CostLimitExceeded
from chalkline.functions.parsing import VISUAL_REPLY, parse_visual
from chalkline.operators.models import vision_table
from chalkline.profile import Profile
from chalkline.providers import Provider

# Estimated cost of a frame and the default limit, in dollars; frames asked about at once.
FRAME_COST, DEFAULT_LIMIT = 0.01, 2.00
IN_FLIGHT = 2


def estimated_cost(frames: int) -> float:
    return frames * FRAME_COST


def check_cost(frames: int, limit: float = DEFAULT_LIMIT) -> float:
    """The estimate; an error, before anything is spent, if it is over the limit."""
    cost = estimated_cost(frames)
    if cost > limit:
        raise CostLimitExceeded(f"{frames} frames would cost about ${cost:.2f}, over the limit of ${limit:.2f}")
    return cost


def prompt(profile: Profile) -> str:
    """The request for one frame."""
    known = f"; most likely one of {', '.join(profile.code_languages)}" if profile.code_languages else ""
    return (
        "Copy what one frame of a video shows. Answer with one JSON object and nothing else. Its keys: kind (slide, code, whiteboard or other), "
        "text (every readable character of the shown document, exactly and with its line breaks and indentation, without the window's own menus and bars; empty if there is none; no guesses), "
        f"code_language (the programming language if kind is code{known}; else null), description (one line about the frame), "
        "diagram (a drawing of connected shapes as ASCII art with its labels; empty for lists, tables and plain text)."
    )


def visuals(frames: DataFrame, profile: Profile, provider: Provider, model: str, *, limit: float = DEFAULT_LIMIT, in_flight: int = IN_FLIGHT) -> DataFrame:
    """The table visuals; ``frames`` has job_id, timestamp, image and mime. Frames without a usable reply are left out."""
    check_cost(frames.count(), limit)
    replies = vision_table(frames.repartition(in_flight), ["job_id", "timestamp"], provider, model, prompt(profile), parse_visual, VISUAL_REPLY)
    order = Window.partitionBy("job_id").orderBy("timestamp")
    kept = replies.where(F.col("reply").isNotNull()).select("job_id", "timestamp", "reply.*")
    return kept.withColumn("vis_ord", F.row_number().over(order) - 1).select("job_id", "vis_ord", "timestamp", "kind", "text", "code_language", "description", "diagram")
