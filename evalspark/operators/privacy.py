"""Masking of free text and reversible encryption of columns."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.text import replace_unless
from evalspark.schema import BLOCKS, NOT_FOUND

#: Columns encrypted by default, expressions of names, and what replaces them.
SENSITIVE = ["Number", "Acronym", "Title", "Abstract"]
NAME_IN_CONTEXT = r"(?U)(?<!^[\s\n])(?<![.!?]\s)\b[A-Z][a-z]{3,}\b"
TWO_CAPITALS = r"(?U)\b[A-Z][A-Z0-9-]{2,}[A-Z0-9]\s+[A-Z][A-Z0-9-]{1,}[A-Z0-9]\b"
CAPITALS = r"(?U)\b[A-Z][A-Z0-9-]{1,}[A-Z]\b"
NAME, NUMBER, ACRONYM, TITLE = "[NAME]", "[NUMBER]", "[ACRONYM]", "[TITLE]"

#: Tokens in capitals that stay as they are.
KEPT_CAPITALS = [
    "NAME", "NUMBER", "ACRONYM", "TITLE", "TRL", "GANTT", "PERT", "FAIR", "AI4EUROPE", "CHIPS", "CHIPS-JU",
    "ECSEL", "EDIH", "DAIRO", "DESTIN-E", "EDMO", "EFIS", "ENISA", "ERGA", "EUROHPC", "EUROHPC-JU", "EUROCORES",
    "ELRC", "EU-ROBOTICS", "GAIA-X", "GEANT", "IPCEI", "FLAGSHIP", "TESTA", "EFFRA", "AI4EU", "EOSC", "HORIZON",
    "DIGITAL", "EUROPE", "P4PLANET", "IAM4EU", "PHOTONICS21",
]

#: Capitalised words that aren't names. Our own short list: give ``keep_words`` a fuller one for real texts.
KEPT_WORDS = """
    About Above Abstract Academic According Across Action Actions Activities Activity Additionally Adequate After Also
    Although Among Analysis Application Approach April Area Areas Assessment August Background Based Because Before
    Besides Between Beyond Both Budget Call Capacity Clear Collaboration Commission Communication Concept Consortium
    Contribution Cost Criterion Data December Deliverables Design Despite Development Digital Dissemination During Each
    Either English Ethics Europe European Evaluation Evidence Excellence Experience Expertise Exploitation February Final
    First Following Framework Friday From Further Future Gender General Given Goals Good Governance Have Horizon However
    Impact Impacts Implementation Indeed Industry Information Infrastructure Innovation Into January July June Knowledge
    Limited Management March Market Measures Method Methodology Methods Milestones Monday Moreover Nevertheless November
    Objective Objectives October Open Other Outcomes Overall Panel Participants Partner Partners Plan Planning Policy
    Proposal Project Quality Report Research Resource Resources Results Risk Saturday Science Scientific Scope Score
    Second September Several Since Society Some Specific Stakeholders Strategy Strengths Such Summary Sunday Table Task
    Tasks Team Technology That Their There Therefore These They This Those Though Threshold Through Thursday Title Total
    Training Tuesday Union Very Wednesday Weaknesses What When Where Which While With Within Work
""".split()


def load_key(name: str = "AESGCM_KEY") -> bytes | None:
    """The key in an environment variable (urlsafe base64), or None; ValueError if it is no AES key."""
    raw = os.environ.get(name)
    return checked_key(base64.urlsafe_b64decode(raw)) if raw else None


def generate_key() -> bytes:
    """A new 128-bit key."""
    return os.urandom(16)


def checked_key(key: bytes) -> bytes:
    if len(key) not in (16, 24, 32):
        raise ValueError("an AES key has 16, 24 or 32 bytes")
    return key


def _key_column(df: DataFrame, key: bytes) -> Column:
    """The key as a scalar subquery over one local row, so that no plan shows it."""
    return df.sparkSession.createDataFrame([(bytearray(checked_key(key)),)], "k binary").select("k").scalar()


def encrypted(df: DataFrame, columns: Iterable[str], key: bytes) -> DataFrame:
    """Columns as hex of a random 12-byte nonce, ciphertext and tag (AES-GCM); nulls stay null, absent columns are skipped."""
    k = _key_column(df, key)
    return df.withColumns({c: F.lower(F.hex(F.aes_encrypt(F.col(f"`{c}`").cast("string"), k, F.lit("GCM"), F.lit("DEFAULT")))) for c in columns if c in df.columns})


def decrypted(df: DataFrame, columns: Iterable[str] = SENSITIVE, key: bytes | None = None, lenient: bool = False) -> DataFrame:
    """The inverse of :func:`encrypted`. Without a key the table is unchanged; a wrong tag raises, or is null if ``lenient``."""
    if key is None:
        return df
    k, decrypt = _key_column(df, key), F.try_aes_decrypt if lenient else F.aes_decrypt
    return df.withColumns({c: decrypt(F.unhex(F.col(f"`{c}`")), k, F.lit("GCM"), F.lit("DEFAULT")).cast("string") for c in columns if c in df.columns})


def mask_literals(text: Column, number: Column | None = None, acronym: Column | None = None, title: Column | None = None) -> Column:
    """Placeholders for the report's own number, acronym and title, in this order; a null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for value, mark in ((number, NUMBER), (acronym, ACRONYM), (title, TITLE)):
        if value is not None:
            known = value.isNotNull() & (value != "") & (value != NOT_FOUND)
            out = F.when(known, F.replace(out, value, F.lit(mark))).otherwise(out)
    return out


def mask_names(text: Column, keep_words: Iterable[str] = KEPT_WORDS) -> Column:
    """A capitalised word inside a sentence is a name unless it is kept."""
    return replace_unless(text, NAME_IN_CONTEXT, NAME, keep_words)


def mask_capitals(text: Column, keep: Iterable[str] = KEPT_CAPITALS, entities: Iterable[str] = ()) -> Column:
    """Two tokens in capitals are a name, and one is unless it is kept and no entity."""
    return replace_unless(F.regexp_replace(text, TWO_CAPITALS, NAME), CAPITALS, NAME, set(keep) - set(entities))


def mask_text(text: Column, number: Column | None, acronym: Column | None, title: Column | None, keep_words: Iterable[str] = KEPT_WORDS, keep: Iterable[str] = KEPT_CAPITALS, entities: Iterable[str] = ()) -> Column:
    """All masks, in order."""
    return mask_capitals(mask_names(mask_literals(text, number, acronym, title), keep_words), keep, entities)


def anonymize(
    df: DataFrame,
    key: bytes | None = None,
    encrypt_columns: Iterable[str] | None = None,
    encrypt: bool = False,
    keep_words: Iterable[str] = KEPT_WORDS,
    keep: Iterable[str] = KEPT_CAPITALS,
    entities: Iterable[str] = (),
) -> DataFrame:
    """Masks the criterion texts (or, without all three, the list column Criterion) and encrypts sensitive columns.

    ``encrypt`` without a key raises ValueError: nothing is left in clear by mistake.
    """
    if encrypt and key is None:
        raise ValueError("encryption was asked for, but there is no key")
    own = [F.col(c).cast("string") if c in df.columns else None for c in ("Number", "Acronym", "Title")]
    mask = lambda c: mask_text(c, *own, keep_words, keep, entities)
    if all(b in df.columns for b in BLOCKS):
        df = df.withColumns({b: mask(F.col(b)) for b in BLOCKS})
    elif "Criterion" in df.columns:
        df = df.withColumn("Criterion", F.transform("Criterion", mask))
    return encrypted(df, SENSITIVE if encrypt_columns is None else encrypt_columns, key) if encrypt else df
