"""Personal-identifier helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .._util import ColumnOrName, col

from ..fixed_values import PERSON_ID_DIGITS


def person_id_flag(length_col: ColumnOrName) -> Column:
    """``SIM`` when the extracted digit run has 11 digits, else ``NAO`` (NULL included)."""
    return F.when(col(length_col) == PERSON_ID_DIGITS, "SIM").otherwise("NAO")


def tokenize_id(c: ColumnOrName, key: str, mode: str = "aes-ecb") -> Column:
    """Deterministic token for an identifier; NULL stays NULL.

    ``aes-ecb``: ``base64(aes_encrypt(c, key, 'ECB', 'PKCS'))`` — equal ids give equal
    tokens under one key (joinable), key of 16/24/32 bytes. ``sha2``: salted SHA-256 hex
    (one-way, checkable by any SQL engine). ``aes-gcm`` is randomised (not joinable).
    The key is a caller-held secret; it is visible in query plans, so plans must not be
    logged where the key would leak.
    """
    c = col(c).cast("string")
    if mode == "aes-ecb":
        return F.base64(F.aes_encrypt(c, F.lit(key), F.lit("ECB"), F.lit("PKCS")))
    if mode == "aes-gcm":
        return F.base64(F.aes_encrypt(c, F.lit(key), F.lit("GCM")))
    if mode == "sha2":
        return F.when(c.isNotNull(), F.sha2(F.concat(F.lit(key), c), 256))
    raise ValueError(f"unknown mode {mode!r}")
