"""Masking and tokens for personal data."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_email(c: str | Column) -> Column:
    """Keep the first letter of the local part and the domain."""
    return F.regexp_replace(_col(c), r"([A-Za-z0-9])[A-Za-z0-9._%+-]*@([A-Za-z0-9.-]+)", "$1***@$2")


def mask_phone(c: str | Column) -> Column:
    """Hide every digit that has at least three more digits to its right."""
    return F.regexp_replace(_col(c), r"[0-9](?=(?:[^0-9]*[0-9]){3})", "*")


def mask_name(c: str | Column) -> Column:
    return F.mask(_col(c), F.lit("X"), F.lit("x"), F.lit("n"))


def mask_address(c: str | Column) -> Column:
    return F.mask(_col(c), F.lit("*"), F.lit("*"), F.lit("#"))


MASKS = {"email": mask_email, "phone": mask_phone, "name": mask_name, "address": mask_address}


def mask_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Mask the named columns by kind: {"c_name": "name", ...}."""
    unknown = set(kinds.values()) - set(MASKS)
    if unknown:
        raise ValueError(f"no mask for {sorted(unknown)}")
    return df.withColumns({c: MASKS[kind](c) for c, kind in kinds.items()})


def token(value: str | Column, secret: bytes) -> Column:
    """HMAC-SHA256 of the value's text as hex, as a plain expression.

    Equal values get equal tokens, so tables still join on the token. The padded key is
    a literal of the plan: hand it over from a secret store and keep plans private.
    """
    key = hashlib.sha256(secret).digest() if len(secret) > 64 else secret
    key = key.ljust(64, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in key))
    outer = F.lit(bytes(b ^ 0x5C for b in key))
    message = F.encode(_col(value).cast("string"), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)
