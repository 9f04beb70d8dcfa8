"""Thresholds and the language dimension of the curation pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the curation gates; times in seconds unless named otherwise."""

    min_duration: float = 120.0
    max_duration: float = 14_400.0
    min_speech_ratio: float = 0.45
    max_speech_ratio: float = 0.98
    min_turns: int = 20
    min_turns_per_min: float = 3.0
    max_dominance: float = 0.75
    min_overlap_ratio: float = 0.005
    max_overlap_ratio: float = 0.35
    min_segment_ms: int = 300
    backchannel_ms: int = 1_200
    verify_windows: int = 5
    verify_window_sec: float = 45.0
    min_votes: int = 2
    min_agreement: float = 0.6
    silence_gap_ms: int = 5_000
    max_chunk_ms: int = 600_000
    min_chunk_ms: int = 120_000
    cc_only: bool = False


@dataclass(frozen=True)
class WindowPlan:
    """Fixed values of training windows: lengths in ms, loudness as root mean square."""

    target_ms: int = 120_000
    min_ms: int = 30_000
    max_ms: int = 180_000
    min_gap_ms: int = 400
    min_rms: float = 0.005
    frame_hz: float = 12.5
    sample_rate: int = 24_000
    val_frac: float = 0.05
    seed: int = 0


# Codes and names of Indic languages.
INDIC = {
    "hi": "Hindi", "bn": "Bengali", "ta": "Tamil", "te": "Telugu", "mr": "Marathi", "gu": "Gujarati", "kn": "Kannada", "ml": "Malayalam", "pa": "Punjabi",
    "or": "Odia", "as": "Assamese", "ur": "Urdu", "ne": "Nepali", "si": "Sinhala", "sd": "Sindhi", "ks": "Kashmiri", "mai": "Maithili", "sa": "Sanskrit",
    "kok": "Konkani", "doi": "Dogri", "mni": "Manipuri", "brx": "Bodo", "sat": "Santali", "bho": "Bhojpuri", "raj": "Rajasthani", "mag": "Magahi", "tcy": "Tulu",
}

# Media type by file extension.
MEDIA_TYPES = {".wav": "audio/wav", ".mp3": "audio/mpeg", ".m4a": "audio/mp4", ".ogg": "audio/ogg", ".flac": "audio/flac", ".webm": "audio/webm", ".aac": "audio/aac"}
