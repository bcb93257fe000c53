"""What is known of a dialogue corpus: which columns play which role, and what its media need."""

from __future__ import annotations

from dataclasses import dataclass, field

NONE, SEEKING, PROVIDING = 0, 1, 2
INCOMPLETE, COMPLETE = 0, 1
#: Role columns that every table has after its cleaner; the file name may be null.
ROLES = ("conv_id", "utter_id", "utterance", "speaker", "file_name")


@dataclass(frozen=True)
class SourceSpec:
    """Column names of a corpus by role, the extra columns that its result keeps, and its media flags."""

    name: str
    conv: str
    utter: str
    text: str
    speaker: str
    extras: tuple[str, ...] = ()
    url: str | None = None
    timestamp: str | None = None
    download: bool = False
    video_to_audio: bool = False
    audio_split: bool = False
    file_format: str = "wav"
    labels_per_conversation: int = 10
    checks_per_conversation: int = 5
    path: str = "file_path"
    options: dict = field(default_factory=dict, hash=False)

    @property
    def columns(self) -> dict[str, str]:
        """Own name -> role name."""
        return dict(zip((self.conv, self.utter, self.text, self.speaker, self.path), ROLES, strict=True))


ANNOMI = SourceSpec("annomi", "transcript_id", "utterance_id", "utterance_text", "interlocutor", ("client_talk_type", "main_therapist_behaviour"), "video_url", "timestamp", audio_split=True)
DAILYTALK = SourceSpec("dailytalk", "dialog_idx", "utterance_idx", "text", "speaker", ("emotion", "act"))
MELD = SourceSpec("meld", "Dialogue_ID", "Utterance_ID", "Utterance", "Speaker", ("Emotion", "Sentiment"), video_to_audio=True, file_format="mp4")
MUSTARD = SourceSpec("mustard", "conv_id", "utter_id", "utterance", "speaker", ("scam",), video_to_audio=True, audio_split=True, file_format="mp4")
GENERIC = SourceSpec("generic", "conv_id", "turn", "text", "role")
#: In the order in which merged ids are numbered.
SOURCES = {s.name: s for s in (MELD, DAILYTALK, MUSTARD, ANNOMI)}
