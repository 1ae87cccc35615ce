"""Evaluation texts leaking into training text (problem 6).

Every task builds one Aho-Corasick automaton over the normalised evaluation items: its patterns are
all runs of SEED_WORDS words of every item, written without white space. A document is normalised
the same way (lower case, letters and digits only, so case, punctuation and layout vanish), scanned
once in full, and the hits are chained along the diagonal of each item into pieces that bridge
lightly retyped words. A piece's size is the number of item words found in it, letter by letter or
within a few letters where a word was retyped. Pieces of at most PHRASE_WORDS words are turns of
phrase and count for nothing; an item leaked into a document if its larger pieces, taken in the
item's order, hold LEAK_WORDS words or more.

Only the items travel to the tasks, at most SLICE_BYTES at a time: a larger set is cut into slices
by a hash of the item, each with an automaton and a scan of its own. How many items share a seed is
counted over all of them, so the slices together give what one automaton would. Nothing of the
documents is shuffled, and one document is one scan of linear length, so no source or project can be too hot.

An item is only looked at in a document if one of its raising seeds stands there. Every clean run of
WINDOW_WORDS words holds one, and so does any seed that no more than two items share, or FEW_SEEDS of
them that no more than FEW_ITEMS share; what can be missed is a passage retyped in every WINDOW_WORDS
words nearly all of whose clean seeds stand in more than FEW_ITEMS items. A piece that holds fewer than GROW_WORDS words
in seeds, or MIN_SEEDS hits, is not grown.

Defined results: null or empty documents and items match nothing; items shorter than LEAK_WORDS
words can't leak; items with equal texts leak together; every document counts by its own id, equal
text or not; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import cut

SEED_WORDS = 3
PHRASE_WORDS = 12
LEAK_WORDS = 20
#: Words that seeds and bridges must hold before a piece is looked at for retyped words at its ends.
GROW_WORDS = 7
#: Seeds that a piece of more than PHRASE_WORDS words has at the very least, its bridges and ends taken off.
MIN_SEEDS = 2
#: A clean run of so many words always brings its item into closer view, and so do FEW_SEEDS seeds that
#: no more than FEW_ITEMS items share.
WINDOW_WORDS = 8
FEW_SEEDS, FEW_ITEMS = 3, 16
#: Words a retyped stretch may span between two seeds, and letters by which it may have grown.
BRIDGE_WORDS = 5
BRIDGE_SLACK = 24
#: Bytes of items in one automaton, which lives in every Python worker and takes some 300 bytes for each of these.
SLICE_BYTES = 8_000_000

_WORD = re.compile(r"[^\W_]+")
_REST = re.compile(r"[\W_]+")


_ASCII_REST = bytes(c for c in range(128) if not chr(c).isalnum())


def squeeze(text: str) -> str:
    low = text.lower()
    if low.isascii():
        return low.encode().translate(None, _ASCII_REST).decode()
    return _REST.sub("", low)


def offsets(text: str) -> list[int]:
    """For each letter of the squeezed text the position in the original, for hits only."""
    low = text.lower()
    if len(low) == len(text):
        return [i for m in _WORD.finditer(low) for i in range(*m.span())]
    out = []  # some letters change their length in lower case
    for i, c in enumerate(text):
        out.extend([i] * len(squeeze(c)))
    return out


def _edits(a: str, b: str, most: int) -> bool:
    """Whether a and b are within ``most`` single-letter edits."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return False
    return row[-1] <= most


class Automaton:
    """The items as words with their letter positions, and one automaton over their seeds."""

    def __init__(self, items: list[tuple[int, str]], seed_words: int = SEED_WORDS, shared: dict[str, int] | None = None):
        """shared: for seeds that stand in several items, in how many; by default counted among ``items``."""
        import ahocorasick

        self.items: dict[int, tuple[list[str], list[int]]] = {}
        seeds: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            words = _WORD.findall((text or "").lower())
            if len(words) < seed_words:
                continue
            starts = [0]
            for w in words:
                starts.append(starts[-1] + len(w))
            self.items[item] = (words, starts)
            for q in range(len(words) - seed_words + 1):
                seeds["".join(words[q : q + seed_words])].append((item, q))
        self.k = seed_words
        # The seeds that raise an item at once: those of one or two items only, and in every window of
        # WINDOW_WORDS words the one that the fewest items share, so that each clean run of so many
        # words raises its item while phrases that many items share seldom do.
        spread = {s: (shared.get(s, 1) if shared is not None else len({i for i, _ in at})) for s, at in seeds.items()}
        raises: dict[str, set[int]] = defaultdict(set)
        for item, (words, _) in self.items.items():
            own = ["".join(words[q : q + seed_words]) for q in range(len(words) - seed_words + 1)]
            span = WINDOW_WORDS - seed_words + 1
            for q in range(max(1, len(own) - span + 1)):
                raises[min(own[q : q + span], key=lambda s: (spread[s], s))].add(item)
            for s in own:
                if spread[s] <= 2:
                    raises[s].add(item)
        self.machine = ahocorasick.Automaton()
        for s, at in seeds.items():
            by_item: dict[int, list[int]] = defaultdict(list)
            for item, q in at:
                by_item[item].append(q)
            few = tuple(by_item) if 2 < spread[s] <= FEW_ITEMS else ()
            self.machine.add_word(s, (len(s), tuple(raises.get(s, ())), few, dict(by_item)))
        self.machine.make_automaton()
        self.empty = not seeds

    def hits(self, letters: str) -> dict[int, list[tuple[int, int, int]]]:
        """By item that a seed raises: (first letter, last letter + 1, first word) of all its seeds."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        if self.empty:
            return out
        seen = list(self.machine.iter(letters))
        raised = {i for _, (_, r, _, _) in seen if r for i in r}
        often: dict[int, int] = {}
        for _, (_, _, few, _) in seen:
            for i in few:
                often[i] = often.get(i, 0) + 1
        raised.update(i for i, n in often.items() if n >= FEW_SEEDS)
        for end, (n, _, _, at) in seen if raised else ():
            for item in raised.intersection(at) if len(raised) < len(at) else [i for i in at if i in raised]:
                out.setdefault(item, []).extend((end + 1 - n, end + 1, q) for q in at[item])
        return out

    def pieces(self, letters: str, item: int, hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
        """(words found, first word, last word + 1, first letter, last letter + 1) of each piece."""
        words, starts = self.items[item]
        k, open_, done = self.k, [], []
        for a, b, q in sorted(hits):
            best = None
            keep = []
            for chain in open_:
                if a - chain[3] > starts[min(len(words), chain[1] + BRIDGE_WORDS)] - starts[chain[1]] + BRIDGE_SLACK:
                    done.append(chain)
                    continue
                keep.append(chain)
                if chain[5] < q and a > chain[4] and q - chain[1] <= BRIDGE_WORDS:
                    gap_item, gap_doc = starts[q] - starts[chain[1]], a - chain[3]
                    if gap_doc == gap_item or (q >= chain[1] and -4 <= gap_doc - gap_item <= BRIDGE_SLACK):
                        if best is None or chain[6] > best[6]:
                            best = chain
            open_ = keep
            if best is None:
                # first word, last word + 1, first letter, last letter + 1, start of the last seed in letters, in words, words found
                open_.append([q, q + k, a, b, a, q, k])
                continue
            if q > best[1]:
                between = "".join(words[best[1] : q])
                if _edits(between, letters[best[3] : a], max(1, len(between) // 3)):
                    best[6] += q - best[1]
            best[6] += q + k - max(q, best[1])
            best[1], best[3], best[4], best[5] = q + k, b, a, q
        return [tuple(self._grown(letters, item, c)) for c in (*done, *open_) if c[6] >= GROW_WORDS]

    def _grown(self, letters: str, item: int, c: list) -> list:
        """The piece with the words at its ends that were retyped so that no seed holds them."""
        words, starts = self.items[item]
        q0, q1, a, b, _, _, n = c
        for m in range(min(2 * self.k, len(words) - q1), 0, -1):
            w = "".join(words[q1 : q1 + m])
            if _edits(w, letters[b : b + len(w)], max(1, len(w) // 6)):
                q1, b, n = q1 + m, min(len(letters), b + len(w)), n + m
                break
        for m in range(min(2 * self.k, q0), 0, -1):
            w = "".join(words[q0 - m : q0])
            if a >= len(w) // 2 and _edits(w, letters[max(0, a - len(w)) : a], max(1, len(w) // 6)):
                q0, a, n = q0 - m, max(0, a - len(w)), n + m
                break
        return [n, q0, q1, a, b]

    def leaks(self, text: str) -> list[tuple[int, int, int, int, list[tuple[int, int, int, int, int]]]]:
        """(item, words found, first letter, last letter + 1, pieces) of every item that leaked."""
        letters = squeeze(text)
        out = []
        for item, hits in self.hits(letters).items():
            if len(hits) < MIN_SEEDS:
                continue
            large = sorted(
                (p for p in self.pieces(letters, item, hits) if p[0] > PHRASE_WORDS), key=lambda p: (p[3], p[1])
            )
            found, chosen = _in_order(large)
            if found >= LEAK_WORDS:
                out.append((item, found, min(p[3] for p in chosen), max(p[4] for p in chosen), chosen))
        return out


def _in_order(pieces: list[tuple[int, int, int, int, int]]) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """The pieces, one after the other in both texts, that hold the most words of the item.

    pieces are sorted by first letter. A piece may follow those that end up to two words and eight
    letters into it; the best of them by last word is kept in a tree of prefix maxima."""
    if not pieces:
        return 0, []
    size = max(p[2] for p in pieces) + 1
    tree: list[tuple[int, int]] = [(0, -1)] * (size + 1)
    total, back, waiting = [0] * len(pieces), [-1] * len(pieces), []
    for i, p in enumerate(pieces):
        while waiting and waiting[0][0] <= p[3] + 8:
            _, j = heappop(waiting)
            at = pieces[j][2]
            while at <= size:
                tree[at] = max(tree[at], (total[j], j))
                at += at & -at
        best, at = (0, -1), min(size, p[1] + 2)
        while at > 0:
            best = max(best, tree[at])
            at -= at & -at
        total[i], back[i] = best[0] + p[0], best[1]
        heappush(waiting, (p[4], i))
    i = max(range(len(pieces)), key=total.__getitem__)
    most, chosen = total[i], []
    while i >= 0:
        chosen.append(pieces[i])
        i = back[i]
    return most, chosen[::-1]


def _seeds(items: DataFrame) -> DataFrame:
    """(item_id, seed) of every item, as often as it stands there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = _WORD.findall(text.lower())
                seeds = ["".join(words[q : q + SEED_WORDS]) for q in range(len(words) - SEED_WORDS + 1)]
                yield pd.DataFrame({"item_id": [item] * len(seeds), "seed": seeds}).astype({"item_id": "int64", "seed": "str"})

    return items.mapInPandas(run, "item_id long, seed string")


def _slices(items: DataFrame, most: int) -> list[tuple[list[tuple[int, str]], dict[str, int] | None]]:
    """Items, and how many items share a seed where that isn't for the slice alone to tell, of each slice."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= most:
        return [([(r[0], r[1]) for r in items.collect()], None)]
    n = 1
    while True:  # until no slice is too large, but for single items that are
        n *= 2
        part = F.pmod(F.xxhash64("item_id"), F.lit(n))
        worst = items.groupBy(part.alias("p")).agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("k")).filter((F.col("b") > most) & (F.col("k") > 1))
        if not worst.limit(1).count():
            break
    seeds = cut(_seeds(items).distinct())
    shared = cut(seeds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1"))
    out = []
    for i in range(n):
        own = items.filter(part == i).collect()
        if own:
            mine = seeds.filter(part == i).select("seed").distinct().join(shared, "seed").collect()  # seeds of one slice
            out.append(([(r[0], r[1]) for r in own], {r.seed: r.n for r in mine}))
    return out


#: The machine of the scan a worker is at, so that its next task need not build it again.
_built: dict[str, Automaton] = {}


def _machine(key: str, held) -> Automaton:
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(held.value[0], shared=held.value[1])
    return _built[key]


def find_leaks(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(item_id, doc_id, words, start, end): words of the item found, and where in the original text
    they stand, from the first letter of the first piece to the end of the last."""
    spark = documents.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null").distinct()
    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null and text != ''")
    found = [_scan(texts, spark.sparkContext.broadcast(x)) for x in _slices(items, slice_bytes)]
    return reduce(DataFrame.unionByName, found)


def _scan(texts: DataFrame, held) -> DataFrame:
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = _machine(key, held)
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = machine.leaks(text)
                if found:
                    at = offsets(text)
                    out.extend((item, doc, n, at[a], at[b - 1] + 1) for item, n, a, b, _ in found)
            yield pd.DataFrame(out, columns=["item_id", "doc_id", "words", "start", "end"])

    return texts.mapInPandas(run, "item_id long, doc_id long, words int, start int, end int")
