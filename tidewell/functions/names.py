"""Column-name normalisation and name-based column groups; no data is touched."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidewell.functions.cells import ref

# Name parts that mark an identity column, and the identity columns dropped by default.
IDENTITY_KEYWORDS = ("ip", "port", "timestamp", "time", "id", "index")
IDENTITY_COLUMNS = ("Source_IP", "Destination_IP", "Source_Port", "Destination_Port", "Timestamp")
TARGET = "Label"


def normalize_name(
    name: str,
    strip: bool = True,
    replace_spaces: str | None = "_",
    lowercase: bool = False,
    remove_special_chars: bool = False,
) -> str:
    """Strip, replace spaces, lowercase, remove what is not ``[a-zA-Z0-9_]``, in that order."""
    out = name.strip() if strip else name
    if replace_spaces:
        out = out.replace(" ", replace_spaces)
    if lowercase:
        out = out.lower()
    return re.sub(r"[^a-zA-Z0-9_]", "", out) if remove_special_chars else out


def normalized(names: Sequence[str], **options) -> list[str]:
    """Normalised names; two columns that would end up with one name are an error."""
    renamed = [normalize_name(n, **options) for n in names]
    clashes = {n: c for n, c in Counter(renamed).items() if c > 1}
    if clashes:
        raise ValueError(f"column names collide after normalisation: {sorted(clashes)}")
    return renamed


def normalize_names(df: DataFrame, **options) -> DataFrame:
    """Rename all columns; metadata only."""
    return df.toDF(*normalized(df.columns, **options))


def renamed_count(names: Sequence[str], **options) -> int:
    return sum(a != normalize_name(a, **options) for a in names)


def feature_columns(
    df: DataFrame, target: str = TARGET, features: Sequence[str] | None = None, drops: Sequence[str] = IDENTITY_COLUMNS
) -> list[str]:
    """The given features, else every column but the target and the configured drops."""
    if features is not None:
        return list(features)
    return [c for c in df.columns if c != target and c not in drops]


def feature_target(
    df: DataFrame, target: str = TARGET, features: Sequence[str] | None = None, drops: Sequence[str] = IDENTITY_COLUMNS
) -> DataFrame:
    """Features followed by the target; the scan reads nothing else."""
    return df.select(*[ref(c) for c in feature_columns(df, target, features, drops)], ref(target))


def _tokens(name: str) -> set[str]:
    return {t.lower() for t in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)}


def identity_split(
    names: Sequence[str], target: str = TARGET, match: str = "substring"
) -> tuple[list[str], list[str]]:
    """``(behaviour, identity)`` names.

    ``substring`` looks for the keywords anywhere in the lowercased name (so ``Idle_Max``
    counts as identity); ``token`` only for whole words.
    """
    if match not in ("substring", "token"):
        raise ValueError(f"unknown match {match!r}")

    def hit(name: str) -> bool:
        if match == "token":
            return not _tokens(name).isdisjoint(IDENTITY_KEYWORDS)
        return any(k in name.lower() for k in IDENTITY_KEYWORDS)

    identity = [n for n in names if hit(n)]
    return [n for n in names if n not in identity and n != target], identity
