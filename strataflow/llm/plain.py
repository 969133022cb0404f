"""Plain form of a text: lower-cased words with single blanks between, and no ASCII punctuation."""

from __future__ import annotations

_TO_BLANK = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain_bytes(text: str | None) -> bytes:
    lowered = (text or "").lower().encode("utf-8", "surrogatepass")
    return b" ".join(lowered.translate(_TO_BLANK).split())


def plain(text: str | None) -> str:
    return plain_bytes(text).decode("utf-8", "surrogatepass")
