"""Tables: one row per element, keyed by ``job_id`` and an ordinal; lists stay nested only in artifacts."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

SEGMENT = "struct<start:double,end:double,text:string,words:array<struct<start:double,end:double,text:string,probability:double>>>"
VISUAL = "struct<timestamp:double,kind:string,text:string,code_language:string,description:string,diagram:string>"
NOTE_FIELDS = (
    "concept string, canonical_concept_id string, summary string, code_snippet string, code_language string, diagram string, "
    "pitfalls array<string>, depends_on array<string>, source_timestamp double, partial boolean"
)
NOTE = "struct<" + NOTE_FIELDS.replace(" string", ":string").replace(" array", ":array").replace(" double", ":double").replace(" boolean", ":boolean").replace(", ", ",") + ">"
KINDS = ("slide", "code", "whiteboard", "other")

#: Name of each artifact's file in a job folder, the columns of the document in it, and the stage that makes it.
ARTIFACTS: dict[str, tuple[str, str, str]] = {
    "video": ("video_meta.json", "source_path string, audio_path string, duration_s double, width int, height int, fps double, audio_sample_rate int, audio_channels int", "ingest"),
    "transcript": ("transcript.json", f"language string, model_size string, segments array<{SEGMENT}>", "transcribe"),
    "keyframes": ("keyframes.json", "keyframes array<struct<timestamp:double,image_path:string,phash:string>>", "detect_scenes"),
    "visuals": ("visuals.json", f"extracts array<{VISUAL}>", "extract_visuals"),
    "timeline": ("aligned.json", f"chunks array<struct<start:double,end:double,segments:array<{SEGMENT}>,visuals:array<{VISUAL}>,flags:array<string>>>", "align"),
    "alignment_report": ("alignment_report.json", "chunk_count int, segment_count int, lookahead_moves int, scroll_merges int, orphans int", "align"),
    "notes": ("notes.json", f"notes array<{NOTE}>", "distill"),
    "concepts": ("concepts.json", "concepts map<string,string>", "distill"),
    "run_stats": ("run_stats.json", "stage_seconds map<string,double>, total_seconds double", "process"),
}

#: Exploded tables, as the operators take them.
TABLES: dict[str, str] = {
    "segments": "job_id string, seg_ord int, start double, end double, text string, words array<struct<start:double,end:double,text:string,probability:double>>",
    "visuals": "job_id string, vis_ord int, timestamp double, kind string, text string, code_language string, description string, diagram string",
    "keyframes": "job_id string, kf_ord int, timestamp double, image_path string, phash string",
    "scenes": "job_id string, start double, end double",
    "notes": f"job_id string, note_ord int, {NOTE_FIELDS}",
    "kb_points": "id string, collection string, source_video string, source_timestamp double, canonical_concept_id string, concept string, summary string, "
    "code_language string, depends_on array<string>, text string, note string, vector array<double>",
    "llm_cache": "key string, response string",
}


def struct(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def table(name: str) -> StructType:
    return struct(TABLES[name])


def artifact(name: str) -> StructType:
    return struct(ARTIFACTS[name][1])
