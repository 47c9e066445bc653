"""Recursive text chunking as spans of the original text."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

# --- fixed values: the splitter's separators, from coarse to fine ------------------------
SEPARATORS = ("\n\n", "\n", " ", "")
# ----------------------------------------------------------------------------------------

Span = tuple[int, int]


def _pieces(text: str, span: Span, sep: str) -> Iterator[Span]:
    """Cut a span before every occurrence of ``sep`` (between all characters if empty)."""
    lo, hi = span
    if not sep:
        yield from ((i, i + 1) for i in range(lo, hi))
        return
    at = text.find(sep, lo, hi)
    while at != -1:
        if at > lo:
            yield lo, at
        lo, at = at, text.find(sep, at + len(sep), hi)
    if hi > lo:
        yield lo, hi


def _pack(pieces: list[Span], size: int, overlap: int) -> Iterator[Span]:
    """Join neighbouring pieces up to ``size``; start the next chunk up to ``overlap`` back."""
    window: deque[Span] = deque()
    length = 0
    for piece in pieces:
        n = piece[1] - piece[0]
        if window and length + n > size:
            yield window[0][0], window[-1][1]
            while window and (length > overlap or length + n > size):
                first = window.popleft()
                length -= first[1] - first[0]
        window.append(piece)
        length += n
    if window:
        yield window[0][0], window[-1][1]


def _spans(text: str, span: Span, seps: tuple[str, ...], size: int, overlap: int) -> Iterator[Span]:
    level = next(i for i, s in enumerate(seps) if not s or text.find(s, *span) != -1)
    sep, finer = seps[level], seps[level + 1 :]
    run: list[Span] = []
    for piece in _pieces(text, span, sep):
        if piece[1] - piece[0] < size:
            run.append(piece)
            continue
        yield from _pack(run, size, overlap)
        run = []
        if finer:
            yield from _spans(text, piece, finer, size, overlap)
        else:
            yield piece
    yield from _pack(run, size, overlap)


def chunk_spans(text: str, size: int, overlap: int, seps: tuple[str, ...] = SEPARATORS) -> list[Span]:
    """Spans of the chunks, each trimmed of outer white space; empty ones are left out."""
    if not text:
        return []
    if seps[-1] != "":
        seps = (*seps, "")
    out = []
    for lo, hi in _spans(text, (0, len(text)), seps, size, overlap):
        chunk = text[lo:hi]
        left = len(chunk) - len(chunk.lstrip())
        body = chunk.strip()
        if body:
            out.append((lo + left, lo + left + len(body)))
    return out
