"""Runs of ASCII letters and digits and of any other character beyond ASCII, A-Z lower-cased."""

from __future__ import annotations

import re

# In UTF-8 all bytes of a character beyond ASCII have the top bit, so bytes give the same runs.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order, repeats included."""
    return _TERM.findall(text.lower())
