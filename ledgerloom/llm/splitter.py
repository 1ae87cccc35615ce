"""Splitting oversized items at natural boundaries (problem 8).

A text above the limit is cut by a hierarchy of separators: sections, paragraphs, lines, sentences,
words, characters. Pieces are packed greedily: a piece is filled to the limit, and where the limit
falls inside a unit, the cut goes before that unit if the unit fits into a piece of its own, and
otherwise into the unit, by the next finer separator. Each piece but the first begins with the last
tokens of the one before. Without these overlaps the pieces, joined, are the text, to the letter.

Texts are split inside the task that reads them; nothing is shuffled and no text is ever cut short.
A text of no more bytes than the limit has no more tokens either, so it isn't tokenised.

Defined results: null, empty and small texts give no rows; a text without any boundary is cut
between characters, never inside one; repeated ids give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import DEFAULT_RANKS, encoding

LIMIT = 2048
OVERLAP = 64
# Short forms whose full stop doesn't end a sentence, in lower case.
SHORT = "no nos qty sec para approx vs ref rev dept est inc co corp ltd fig ea dwg spec mr mrs ms dr st ave blvd rd e.g i.e etc incl max min".split()

_SECTION = re.compile(r"(?:\A|(?<=\n))(?=[ \t]*(?:#{1,6}[ \t]+\S|(?=[^\n]*[A-Z]{3})[A-Z0-9][A-Z0-9 &/,.'()\-]{2,60}:?[ \t]*\r?\n))|(?<=\f)|(?:\r?\n[ \t]*){3,}")
_PARAGRAPH = re.compile(r"\r?\n[ \t]*(?:\r?\n[ \t]*)+")
_LINE = re.compile(r"\r\n|\n|\r| | ")
_SENTENCE = re.compile(r"[.!?](?:[\"'”’)\]]{1,3})?\s+|[。！？]")
_WORD = re.compile(r"(?<=\S)(?=\s)")


def _shortened(text: str, stop: int) -> bool:
    """Whether the word before the full stop at ``stop`` is a short form or a single letter."""
    near = text[max(0, stop - 12) : stop].split()
    word = near[-1].lstrip("(\"'").lower() if near else ""
    return word in SHORT or (len(word) == 1 and word.isalpha())


def boundaries(text: str) -> list[list[int]]:
    """The positions at which a unit of each level may begin, coarsest level first, each list sorted
    and holding 0 and the end; finer levels include the coarser."""
    n, out, held = len(text), [], {0, len(text)}
    for level in (_SECTION, _PARAGRAPH, _LINE, _SENTENCE, _WORD):
        for m in level.finditer(text):
            if level is _SENTENCE and m[0][0] == "." and _shortened(text, m.start()):
                continue
            held.add(m.end())
        out.append(sorted(held))
    assert out[0][0] == 0 and out[0][-1] == n
    return out


def split(text: str, encode, token_bytes, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """(first character, first new character, end, tokens) of each piece of a text above the limit;
    no pieces for a text within it."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    tokens = encode(text)
    if len(tokens) <= limit:
        return []
    # start of each token in characters; one that begins inside a character counts from that character
    ends, at = [], 0
    raw = [token_bytes(t) for t in tokens]
    if text.isascii():
        for b in raw:
            ends.append(at)
            at += len(b)
    else:
        for b in raw:
            ends.append(at)
            at += sum((x & 0xC0) != 0x80 for x in b)
        ends = [e - 1 if raw[i][0] & 0xC0 == 0x80 else e for i, e in enumerate(ends)]
    starts = [*ends, len(text)]
    levels = boundaries(text)
    out, new, first = [], 0, 0
    while new < len(text):
        room = limit
        while True:
            head = bisect_left(starts, first)
            reach = min(len(tokens), head + room)
            end = len(text) if reach == len(tokens) else _cut(levels, starts, new, starts[reach], limit - overlap)
            if end <= new:  # a single character of many tokens, or room used up by the overlap
                end = new + 1
            own = encode(text[first:end])
            if len(own) <= limit or end == new + 1:
                break
            room -= max(1, len(own) - limit)
        while len(own) > limit and first < new:  # only where one character needs more room than the overlap leaves
            first += 1
            own = encode(text[first:end])
        out.append((first, new, end, len(own)))
        new, first = end, end - _tail(own, token_bytes, overlap)
    return out


def _tail(tokens: list[int], token_bytes, n: int) -> int:
    """Characters that the last n tokens hold; a character begun by the token before takes that too."""
    n = min(n, len(tokens))
    while 0 < n < len(tokens) and token_bytes(tokens[-n])[0] & 0xC0 == 0x80:
        n += 1
    return sum((x & 0xC0) != 0x80 for t in tokens[len(tokens) - n :] for x in token_bytes(t))


def _cut(levels: list[list[int]], starts: list[int], new: int, reach: int, most: int) -> int:
    """The end of a piece whose new text begins at ``new`` and can't go beyond ``reach``."""
    for level in levels:
        i = bisect_right(level, reach) - 1
        unit, after = level[i], level[min(i + 1, len(level) - 1)]
        if unit == reach:
            return reach
        if unit > new and bisect_left(starts, after) - bisect_left(starts, unit) <= most:
            return unit
    i = bisect_right(levels[-1], reach) - 1
    return levels[-1][i] if levels[-1][i] > new else reach


def pieces(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, ranks_path: str = DEFAULT_RANKS, with_text: bool = True) -> DataFrame:
    """(doc_id, piece, start, new_start, end, tokens[, text]) of every document above the limit.

    start to end is the piece in the characters of the text, start to new_start what it repeats."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(ranks_path)
        names = ["doc_id", "piece", "start", "new_start", "end", "tokens", *["text"] * with_text]
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = split(text, enc.encode_ordinary, enc.decode_single_token_bytes, limit, overlap)
                if found:
                    rows = [(doc, i, a, b, c, n, *[text[a:c]] * with_text) for i, (a, b, c, n) in enumerate(found)]
                    yield pd.DataFrame(rows, columns=names)

    large = documents.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & (F.octet_length("text") > limit))
    return large.mapInPandas(run, "doc_id long, piece int, start int, new_start int, end int, tokens int" + ", text string" * with_text)
