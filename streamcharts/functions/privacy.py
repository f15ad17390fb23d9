"""Keyed user pseudonym (P2/F8) as a native Spark expression.

HMAC-SHA256(salt, user) = SHA256(opad || SHA256(ipad || user)), where the
key is the salt (hashed first when longer than the SHA-256 block) padded
with zeros to 64 bytes and ipad/opad are the key xor 0x36 / 0x5c. The pads
are computed once on the driver; the rest is two built-in ``sha2`` calls,
so it runs inside whole-stage codegen instead of a Python UDF.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from streamcharts.constants import ANON_USER

_BLOCK = 64


def hmac_pads(salt: str | bytes) -> tuple[bytes, bytes]:
    key = salt.encode() if isinstance(salt, str) else bytes(salt)
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256_hex(value: Column, salt: str | bytes) -> Column:
    """Lower-case hex HMAC-SHA256 of ``cast(value as string)``; null stays null."""
    ipad, opad = hmac_pads(salt)
    msg = value.cast("string").cast("binary")
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), msg), 256))
    return F.sha2(F.concat(F.lit(opad), inner), 256)


def pseudonym(user: Column, salt: str | bytes) -> Column:
    """User pseudonym; a missing user id becomes the shared ``anon`` listener."""
    return F.coalesce(hmac_sha256_hex(user, salt), F.lit(ANON_USER))
