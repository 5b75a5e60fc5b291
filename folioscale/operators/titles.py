"""Where titles stand in a text, and the sections that they begin.

A text is folded once, with the place of every folded character. One automaton
finds all titles in one pass over it; sections are then chosen from ranked places.
"""

from __future__ import annotations

import re
from collections import defaultdict

import ahocorasick
import numpy as np

# Typographic characters and what they match as.
FOLDED = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "−": "-", "ﬁ": "fi", "ﬂ": "fl", "…": "...", "­": ""}
# a single space stays as it is
_SPECIAL = re.compile(r"(?<=\w)-[ \t]*\n\s*(?=[^\W\d_A-Z])| \s+|[^\S ]\s*|[" + "".join(FOLDED) + "]")
_WORD = re.compile(r"[^\W_]+")
#: Characters behind which a table's rows are no longer looked for.
TABLE_REACH = 2000


def fold(text: str) -> tuple[str, np.ndarray]:
    """The text in lower case with single spaces, plain quotes and dashes and rejoined words; and where each character stands."""
    out, places, done = [], [], 0
    for m in _SPECIAL.finditer(text):
        out.append(text[done : m.start()])
        places.append(np.arange(done, m.start()))
        put = FOLDED.get(m[0], "" if m[0].startswith("-") else " ")
        out.append(put)
        places.append(np.full(len(put), m.start()))
        done = m.end()
    out.append(text[done:])
    places.append(np.arange(done, len(text) + 1))
    whole = "".join(out)
    low = whole.lower()
    if len(low) != len(whole):  # a letter whose lower case is longer stays, so that places hold
        low = "".join(c if len(c) == 1 else x for x, c in ((x, x.lower()) for x in whole))
    return low, np.concatenate(places)


def automaton_of(names: list[str]) -> ahocorasick.Automaton:
    """One automaton for all names but empty ones."""
    automaton = ahocorasick.Automaton()
    for name in names:
        if name:
            automaton.add_word(name, name)
    if len(automaton):
        automaton.make_automaton()
    return automaton


def all_places(automaton: ahocorasick.Automaton, text: str) -> dict[str, list[int]]:
    """The names that stand in a text and their places, overlapping ones too, in one pass."""
    places: dict[str, list[int]] = defaultdict(list)
    for last, name in automaton.iter(text) if len(automaton) else ():
        places[name].append(last - len(name) + 1)
    return places


def stands_alone(text: str, begin: int, end: int) -> bool:
    """Whether no letter or digit goes on before or behind a part that begins or ends with one."""
    return not (text[end : end + 1].isalnum() and text[end - 1].isalnum()) and not (begin and text[begin - 1].isalnum() and text[begin].isalnum())


class TitleIndex:
    """Places of some titles in a text."""

    def __init__(self, text: str, titles: list[str]):
        self.text = text
        self.folded, self.places = fold(text)
        self.names = {t: fold(t.strip())[0] for t in titles}
        self.held = all_places(automaton_of(sorted({n for n in self.names.values() if _WORD.search(n)})), self.folded)
        breaks = np.array([m.start() for m in re.finditer("\n", text)], dtype=np.int64)
        self.line_begin = np.concatenate([[0], breaks + 1])
        self.line_end = np.concatenate([breaks, [len(text)]])

    def ranked(self, title: str) -> np.ndarray:
        """Places of a title as whole words, headings first: rows of (place, rank), the best rank 0."""
        name = self.names[title]
        found = sorted({int(self.places[a]) for a in self.held.get(name, ()) if stands_alone(self.folded, a, a + len(name))})
        if not found:
            return np.zeros((0, 2), np.int64)
        at = np.array(found)
        line = np.searchsorted(self.line_begin, at, side="right") - 1
        shown = title.strip().lower()
        rank = []
        for p, b, e in zip(found, self.line_begin[line].tolist(), self.line_end[line].tolist(), strict=True):
            row = self.text[b:e].strip()
            opens = not self.text[b:p].strip(" \t")
            near = "".join(c for c in self.text[max(0, p - 5) : p] if c != " ")
            paragraph = p == 0 or "\n\n" in near
            # a line that begins with it, a short line, any line's beginning, a paragraph's, others
            rank.append(0 if opens and row.lower().startswith(shown) else 1 if opens and len(row) <= max(len(shown) + 5, len(shown) * 3 // 2) else 2 if opens else 3 if paragraph else 4)
        return np.column_stack([at, rank])


def best(places: np.ndarray, low: int, high: int) -> int:
    """The first of the best ranked places in [low, high); -1 if there is none."""
    inside = places[(places[:, 0] >= low) & (places[:, 0] < high)]
    return int(inside[np.lexsort((inside[:, 0], inside[:, 1]))[0], 0]) if len(inside) else -1


def find_title(title: str, text: str, begin: int = 0, end: int | None = None) -> int:
    """The best place of a title in a part of a text; -1 if it has none there."""
    return best(TitleIndex(text, [title]).ranked(title), begin, len(text) if end is None else end)


def sections(text: str, titles: list[tuple[str, int]], offsets: dict[int, int], tables: list[str], bound: bool, least: int) -> tuple[str, list[tuple[int, str]]]:
    """What stands before the first title, and (number, content) of each title that is found.

    Titles come in book order. Each stands behind the one before and not before
    its own page begins; with ``bound``, before the page after the next begins
    (the next one, where that is known). Places in a table, from its title to the next empty
    line or ``TABLE_REACH`` characters on, are none. Contents shorter than
    ``least`` are left out.
    """
    index = TitleIndex(text, [*(t for t, _ in titles), *tables])
    tops = [top for t in tables if (top := best(index.ranked(t), 0, len(text) + 1)) >= 0]
    empty = np.array([m.start() for m in re.finditer("(?=\n\n)", text)] + [len(text) + TABLE_REACH + 1])
    widths = [len(t) for t in tables if best(index.ranked(t), 0, len(text) + 1) >= 0]
    stops = [min(int(empty[np.searchsorted(empty, a + n)]), a + TABLE_REACH) if empty[np.searchsorted(empty, a + n)] - a <= TABLE_REACH else a + TABLE_REACH for a, n in zip(tops, widths, strict=True)]
    at, behind = [], 0
    for number, (title, page) in enumerate(titles):
        known = [offsets[p] for p in (page + 1, page + 2) if p in offsets] if bound else []
        place = best(index.ranked(title), max(behind, offsets.get(page, 0)), known[0] if known else len(text) + 1)
        if place >= 0 and not any(a <= place < b for a, b in zip(tops, stops, strict=True)):
            at.append((place, number))
            behind = place + len(title)
    cuts = [a for a, _ in at] + [len(text)]
    parts = [(number, text[a:b].strip()) for (a, number), b in zip(at, cuts[1:], strict=True)]
    return text[: cuts[0]].strip(), [(n, c) for n, c in parts if len(c) >= least]
