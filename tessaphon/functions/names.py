"""Names of phones, files and labels."""

from pyspark.sql import functions as F

# Phone labels that get another name.
SAFE_NAMES = {"<p:>": "pause", "?": "unknown", "h\\": "hhh"}
# Suffixes of audio files.
AUDIO_SUFFIXES = (".wav", ".mp3", ".flac", ".ogg", ".m4a", ".aiff", ".aif")


def safe_name(phone):
    out = phone
    for label, name in SAFE_NAMES.items():
        out = F.when(phone == label, name).otherwise(out)
    return out


def partition_name(phone):
    """A name that survives as a partition value: the empty label has one of its own."""
    return F.when(phone == "", "_empty").otherwise(safe_name(phone))


def suffix(path):
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def base_name(path):
    return F.regexp_extract(path, r"([^/]*)/?$", 1)


def stem(name):
    """A file name without its last suffix."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def download_of(name, link_id: str):
    """Whether a file is the download of a link: its name holds the id and the suffix of such files, anywhere."""
    return F.contains(name, F.lit(".opus")) & F.contains(name, F.lit(link_id))


def is_wav(name):
    """Whether a name ends in .wav, in small letters."""
    return F.endswith(name, F.lit(".wav"))


def legacy_chunk_index(chunk_idx, augmented: bool):
    """The number of a chunk's file in older folders: sounds so far, its own copies counted."""
    return (chunk_idx + 1) * (2 if augmented else 1)


def label_of_archive(name, compat: bool = False):
    """A class label from an archive's name; compat strips the characters of ".npz" from both ends."""
    return F.regexp_replace(name, r"^[.npz]+|[.npz]+$", "") if compat else F.regexp_replace(name, r"\.npz$", "")
