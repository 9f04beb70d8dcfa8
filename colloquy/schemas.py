"""Schemas of the corpus: explicit, so that nothing is inferred from data."""

from __future__ import annotations

PROBE = "id string, title string, duration double, license string, channel string, channel_id string, upload_date string, webpage_url string, language string, categories array<string>, tags array<string>"
STATE = "vid string, url string, status string, reason string, stage string, meta string, updated double"
VOTE = "num_speakers int, language string, language_code string, is_conversational boolean, has_turn_taking boolean, is_dubbed_or_voiceover boolean, music_dominant boolean, background_noise string, confidence string, notes string"
SEGMENT = "start double, end double, speaker string"
MARKED = "start double, end double, speaker string, duration double, overlap_sec double, overlap_frac double, clean boolean"
WORD = "speaker string, word string, start double, end double, approx_timestamps boolean"
WINDOW = "path string, duration double"
MANIFEST = (
    "id string, source string, title string, channel string, license string, upload_date string, duration double, language string, language_code string, "
    "conversation struct<n_speakers:int,n_turns:int,overlap_ratio:double,turns_per_min:double,speaker_shares:map<string,double>>, speaker_map map<string,string>, "
    "files struct<mixture:string,stereo:string,channels:array<string>,rttm:string,segments:string>, caveats array<string>, created string"
)
EXPORT = "id string, stereo_filepath string, mixture_filepath string, channel_filepaths array<string>, rttm_filepath string, duration double, lang string, overlap_ratio double, turns_per_min double, license string, source string"
ANALYSIS = (
    "num_speakers int, language string, language_code string, other_languages array<string>, topic string, tone string, setting string, audio_quality string, confidence string, summary string, "
    "speakers array<struct<id:string,apparent_gender:string,notes:string>>, background_sounds array<string>, key_moments array<string>, unclear array<string>, transcript string"
)
