r"""Places where a text may be cut without changing its byte-level BPE tokens.

The split patterns of the supported tokenizers never join a character that is
not white space to white space that follows it, and look behind nowhere. So a
cut between the two leaves every token as it was. White space here is
Unicode's White_Space: Python's ``\s`` without U+001C to U+001F.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: White space and the run after it; each match ends at a safe boundary.
PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
_CUT = re.compile(r"(?<=[\S\x1c-\x1f])(?=[^\S\x1c-\x1f])")
_WIDE = re.compile(r"[^\S\x1c-\x1f]{1024,}+")


def parts(text: str, limit: int) -> Iterator[str]:
    """``text`` in parts of about ``limit`` characters, cut at safe boundaries.

    A run of non-space characters longer than that stays whole. A very wide
    white-space run is a part of its own but for its last character, which is
    where the patterns end that token as well.
    """
    a, n = 0, len(text)
    while n - a > limit:
        cut = _CUT.search(text, a + limit)
        b = cut.start() if cut else n
        yield from _split_wide(text[a:b])
        a = b
    if a < n:
        yield from _split_wide(text[a:]) if n > limit else (text[a:],)


def _split_wide(text: str) -> Iterator[str]:
    a = 0
    for run in _WIDE.finditer(text):
        last = run.end() - 1 if run.end() < len(text) else run.end()
        yield from filter(None, (text[a:run.start()], text[run.start():last]))
        a = last
    if a < len(text):
        yield text[a:]
