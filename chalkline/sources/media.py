"""Media programs and image libraries, each needed only by the stage that uses it.

The programs work on files that the driver (or a worker with the same mount) sees. None of them is
in the test environment, so these functions are exercised through fakes and pure helpers only.
"""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np

from chalkline.errors import ChalklineError, DependencyMissing
from chalkline.operators.scenes import HASH_SIDE
from chalkline.operators.transcripts import CHANNELS, PART_SECONDS, SAMPLE_RATE

#: Bytes that an audio part must have to be one.
LEAST_AUDIO = 1024


def require_programs(*names: str) -> None:
    missing = [n for n in names or ("ffmpeg", "ffprobe") if shutil.which(n) is None]
    if missing:
        raise DependencyMissing(f"not on PATH: {', '.join(missing)}")


def _run(args: list[str]) -> str:
    found = subprocess.run(args, capture_output=True, text=True)
    if found.returncode:
        raise ChalklineError(f"{args[0]} failed: {(found.stderr.strip().splitlines() or ['no message'])[-1]}")
    return found.stdout


def probe_json(video: str) -> str:
    """A media probe's JSON, as ``sources.artifacts.probe`` reads it."""
    return _run(["ffprobe", "-v", "error", "-print_format", "json", "-show_format", "-show_streams", video])


def extract_audio(video: str, audio: str) -> None:
    """Mono sound at 16 kHz as 16-bit samples."""
    _run(["ffmpeg", "-y", "-v", "error", "-i", video, "-vn", "-ac", str(CHANNELS), "-ar", str(SAMPLE_RATE), "-c:a", "pcm_s16le", audio])


def extract_frame(video: str, seconds: float, image: str) -> None:
    _run(["ffmpeg", "-y", "-v", "error", "-ss", f"{seconds:.3f}", "-i", video, "-frames:v", "1", "-q:v", "2", image])
    if not Path(image).is_file():
        raise ChalklineError(f"no frame at {seconds:.3f} s of {video}")


def split_audio(audio: str, duration: float, part: int = PART_SECONDS) -> Iterator[tuple[float, str]]:
    """(offset, file) of each part while the folder lives; a part that fails or is too short ends them, and is an error if it is the first."""
    with tempfile.TemporaryDirectory() as folder:
        offset = 0
        while offset < duration:
            target = Path(folder) / f"part-{offset:06d}.wav"
            try:
                _run(["ffmpeg", "-y", "-v", "error", "-ss", str(offset), "-t", str(part), "-i", audio, "-c", "copy", str(target)])
            except ChalklineError:
                if offset == 0:
                    raise
                return
            if not target.is_file() or target.stat().st_size < LEAST_AUDIO:
                if offset == 0:
                    raise ChalklineError(f"no sound in {audio}")
                return
            yield float(offset), str(target)
            offset += part


def detect_scenes(video: str) -> list[tuple[float, float]]:
    try:
        from scenedetect import ContentDetector, detect
    except ImportError as error:
        raise DependencyMissing("install the package scenedetect") from error
    return [(a.get_seconds(), b.get_seconds()) for a, b in detect(video, ContentDetector())]


def _cosines(n: int) -> np.ndarray:
    k = np.arange(n)
    return 2 * np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))


def perceptual_hash(gray: np.ndarray, side: int = HASH_SIDE) -> str:
    """Hexadecimal hash of ``side`` by ``side`` bits of a square of gray levels, four times as wide: its lowest cosine frequencies against their median."""
    turn = _cosines(len(gray))
    low = (turn @ gray.astype(float) @ turn.T)[:side, :side]
    bits = (low > np.median(low)).reshape(-1)
    return f"{int(''.join('1' if b else '0' for b in bits), 2):0{side * side // 4}x}"


def image_hash(path: str, masks: list[tuple[float, float, float, float]] = (), side: int = HASH_SIDE) -> str:
    """Hash of an image file; mask rectangles (fractions of width and height) are white first."""
    try:
        from PIL import Image, ImageDraw
    except ImportError as error:
        raise DependencyMissing("install the package pillow") from error
    with Image.open(path) as image:
        shown = image.convert("RGB")
    draw = ImageDraw.Draw(shown)
    for x0, y0, x1, y1 in masks:
        draw.rectangle([x0 * shown.width, y0 * shown.height, x1 * shown.width, y1 * shown.height], fill="white")
    return perceptual_hash(np.asarray(shown.convert("L").resize((side * 4, side * 4), Image.LANCZOS)), side)


def scaled_image(path: str, most: int | None) -> bytes:
    """The file's bytes, scaled to ``most`` pixels of width if it is wider; as it is where that fails."""
    data = Path(path).read_bytes()
    if not most:
        return data
    try:
        import io

        from PIL import Image

        with Image.open(path) as image:
            if image.width <= most:
                return data
            out = io.BytesIO()
            image.resize((most, round(image.height * most / image.width))).save(out, format=image.format)
        return out.getvalue()
    except Exception:  # a frame that cannot be scaled is sent as it is
        return data


def local_speech(audio: str, size: str, prompt: str | None, language: str | None):
    """Speech of an audio file by a local model with times of words."""
    try:
        from faster_whisper import WhisperModel
    except ImportError as error:
        raise DependencyMissing("install the package faster-whisper") from error
    from chalkline.providers import Segment, Speech, Word

    segments, info = WhisperModel(size, device="cpu", compute_type="int8").transcribe(audio, word_timestamps=True, vad_filter=True, initial_prompt=prompt, language=language)
    rows = tuple(Segment(s.start, s.end, s.text.strip(), tuple(Word(w.start, w.end, w.word, w.probability) for w in s.words or ())) for s in segments)
    return Speech(language or info.language, rows)
