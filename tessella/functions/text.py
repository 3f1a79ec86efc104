"""Text rules: tile names, prompts, notes and forbidden content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns of tiles and samples.
TILE_NAME = r"^tile_(\d+)_(\d+)\.png$"
SAMPLE_NAME = r"^tile_(\d+)_(\d+)_(\d+)_([a-z]+)"

# Content that a submission must not hold: (reason, field, pattern).
FORBIDDEN = (
    ("key", "text", r"(?i)(api[_-]?key|secret|token|password)\s*[:=]\s*\S{8,}"),
    ("known key", "text", r"(AKIA[0-9A-Z]{16}|hf_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|AIza[0-9A-Za-z_-]{35}|rpa_[A-Za-z0-9]{20,})"),
    ("private key", "text", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("service account", "text", r"\"type\"\s*:\s*\"service_account\""),
    ("env file", "path", r"(^|/)\.([A-Za-z0-9]+[_-])*env($|\.)"),
    ("weights", "path", r"(?i)\.(safetensors|gguf|ckpt|pt)$"),
    ("key file", "path", r"(?i)\.(pem|key|p12)$"),
    ("image outside submissions", "path", r"(?i)^(?!submissions/).*\.(png|jpe?g|webp)$"),
)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """Last folder of a path, empty when there is none."""
    return F.when(F.instr(path, "/") > 0, F.substring_index(F.substring_index(path, "/", -2), "/", 1)).otherwise(F.lit(""))


def tile_part(name: Column, i: int) -> Column:
    """Column (1) or row (2) of a name that matches ``TILE_NAME``; null when the number is too big."""
    return F.split(name, "[_.]")[i].try_cast("bigint")


def parse_rgb(text: Column) -> Column:
    """``"R,G,B"`` -> array of three ints."""
    return F.transform(F.split(text, ","), lambda v: F.trim(v).cast("int"))


def prompt_for(kind: Column, full: str, infill: str, trigger: str, hint: Column | None = None) -> Column:
    """Prompt of one call: ``full`` for seeds, ``infill`` otherwise, ``{trigger}`` filled in, hint appended."""
    p = F.when(kind == "seed", F.lit(full.replace("{trigger}", trigger))).otherwise(F.lit(infill.replace("{trigger}", trigger)))
    return p if hint is None else F.concat_ws(" ", p, F.when(hint != "", hint))


def forbidden_reasons(path: Column, text: Column) -> Column:
    """Array of the rules that a file breaks."""
    hits = [F.when((path if field == "path" else text).rlike(rx), F.lit(why)) for why, field, rx in FORBIDDEN]
    return F.filter(F.array(*hits), lambda z: z.isNotNull())


NOTE_FIELDS = {
    "range": r"(?i)col\w*\s+(\d+\s*(?:-|to)\s*\d+)",
    "rows": r"(?i)rows?\s+(\d+\s*(?:-|to)\s*\d+)",
    "weights": r"(\S+\.safetensors)",
    "steps": r"(?i)steps?\W+(\d+)",
    "command": r"((?:python|node)3?\s+\S+)",
}


def note_fields(text: Column) -> list[Column]:
    """What a notes file states about columns, rows, weights file, steps and command; null where it does not."""
    out = []
    for name, rx in NOTE_FIELDS.items():
        v = F.regexp_extract(text, rx, 1)
        out.append(F.when(v != "", v).alias(name))
    return out
