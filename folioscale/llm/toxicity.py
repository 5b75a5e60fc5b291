"""Toxicity: a lexicon trie crossed with Levenshtein automata, and context windows.

A lexicon of terms and word beginnings is learned from labelled documents. Its
trie and the automaton of one edit (a letter more, less, other, or two
swapped) are crossed into one finite automaton, which runs over all words of a
batch at once. Each hit is looked at in a window of words: hits inside
quotation marks count apart from plain ones. A logistic regression on what the
hits of a document add up to gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import arrow_map

#: Labelled documents of each class that lexicon and regression are fitted on, at most.
SAMPLE = 1500
#: What an entry must tell: its log odds times the share of the toxic documents that hold it.
GAIN = 0.08
#: Terms from so many letters on are also found with one edit.
FUZZY_FROM = 5
#: Words on either side of a hit that are looked at for quotation marks.
WINDOW = 6
#: Scripts without spaces between words, where a term can begin at every letter.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF))
POINTS = 0x110000


@cache
def _folded() -> np.ndarray:
    """For each code point its lower case, if that is one character."""
    table = np.arange(POINTS)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


def char_codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of UTF-8 bytes, and for each byte the number of characters before it."""
    code = data.astype(np.int64)
    tail = np.concatenate([code & 0x3F, [0, 0, 0]])
    at = np.arange(len(code))
    for least, below, bits in ((0xC2, 0xE0, 0x1F), (0xE0, 0xF0, 0x0F), (0xF0, 0xF5, 0x07)):
        own = at[(data >= least) & (data < below)]
        value = code[own] & bits
        for i in range(1, 2 + (least >= 0xE0) + (least >= 0xF0)):
            value = (value << 6) | tail[own + i]
        code[own] = np.minimum(value, POINTS - 1)
    head = (data & 0xC0) != 0x80
    return _folded()[code[head]], np.concatenate([[0], np.cumsum(head)])


def unspaced(codes: np.ndarray) -> np.ndarray:
    return np.logical_or.reduce([(codes >= a) & (codes <= b) for a, b in UNSPACED])


def without_marks(data: np.ndarray) -> np.ndarray:
    """The bytes with punctuation beyond ASCII (U+00A0 to U+00BF, U+2000 to U+206F) as spaces, at the same places."""
    out = data.copy()
    two = np.flatnonzero(data[:-1] == 0xC2) if len(data) > 1 else np.zeros(0, np.int64)
    two = two[(data[two + 1] & 0xE0) == 0xA0]
    three = np.flatnonzero(data[:-2] == 0xE2) if len(data) > 2 else np.zeros(0, np.int64)
    three = three[(data[three + 1] == 0x80) | (data[three + 1] == 0x81)]
    for at in (two, two + 1, three, three + 1, three + 2):
        out[at] = 0x20
    return out


class Automaton:
    """The crossed automaton of a lexicon. Entries that end with * are word beginnings and match exactly."""

    def __init__(self, entries: list[str], fuzzy_from: int = FUZZY_FROM):
        self.entries = entries
        trie: list[dict[str, int]] = [{}]
        whole: dict[int, int] = {}
        begin: dict[int, int] = {}
        fuzzy_below: list[bool] = [False]
        for number, entry in enumerate(entries):
            node = 0
            word = entry.rstrip("*")
            fuzzy = not entry.endswith("*") and len(word) >= fuzzy_from
            for c in word:
                fuzzy_below[node] |= fuzzy
                if c not in trie[node]:
                    trie[node][c] = len(trie)
                    trie.append({})
                    fuzzy_below.append(False)
                node = trie[node][c]
            fuzzy_below[node] |= fuzzy
            (begin if entry.endswith("*") else whole)[node] = number
        letters = sorted({c for node in trie for c in node})
        self.classes = np.zeros(POINTS, dtype=np.int32)  # class 0: letters of no entry
        for i, c in enumerate(letters):
            self.classes[ord(c)] = i + 1
        symbols = ["", *letters]

        def closure(states: set) -> frozenset:
            """A letter may be left out: one edit, no input."""
            out, todo = set(states), list(states)
            while todo:
                node, edits, due = todo.pop()
                if not due and edits == 0 and fuzzy_below[node]:
                    for child in trie[node].values():
                        s = (child, 1, "")
                        if s not in out:
                            out.add(s)
                            todo.append(s)
            return frozenset(out)

        def step(states: frozenset, c: str) -> frozenset:
            out = set()
            for node, edits, due in states:
                if due:
                    if c == due:
                        out.add((node, edits, ""))
                    continue
                if c and c in trie[node]:
                    out.add((trie[node][c], edits, ""))
                if edits == 0 and fuzzy_below[node]:
                    out.add((node, 1, ""))  # a letter more
                    for child in trie[node].values():
                        out.add((child, 1, ""))  # another letter
                    for first, child in trie[node].items():
                        if c and c in trie[child]:
                            out.add((trie[child][c], 1, first))  # two letters swapped: the first is still due
            return closure(out)

        start = closure({(0, 0, "")})
        number_of = {start: 1}
        order = [frozenset(), start]
        table = [[0] * len(symbols)]
        at = 1
        while at < len(order):
            row = []
            for c in symbols:
                nxt = step(order[at], c)
                if nxt and nxt not in number_of:
                    number_of[nxt] = len(order)
                    order.append(nxt)
                row.append(number_of.get(nxt, 0))
            table.append(row)
            at += 1
        self.table = np.array(table, dtype=np.int32)
        self.whole = np.full(len(order), -1, dtype=np.int32)
        self.edits = np.zeros(len(order), dtype=np.int8)
        self.begin = np.full(len(order), -1, dtype=np.int32)
        for i, states in enumerate(order):
            ends = sorted((edits, whole[node]) for node, edits, due in states if not due and node in whole and (edits == 0 or len(entries[whole[node]]) >= fuzzy_from))
            if ends:
                self.edits[i], self.whole[i] = ends[0]
            starts = [begin[node] for node, edits, due in states if not due and edits == 0 and node in begin]
            if starts:
                self.begin[i] = starts[0]

    def run(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, entry, edits) of the words that match; a whole term goes before a beginning."""
        classes = self.classes[codes]
        live, state = np.arange(len(starts)), np.ones(len(starts), dtype=np.int32)
        begun = np.full(len(starts), -1, dtype=np.int32)
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        i = 0
        while len(live):
            done = ends[live] - starts[live] == i
            if done.any():
                last = state[done]
                ok = self.whole[last] >= 0
                words = live[done][ok]
                hits.append((words, self.whole[last][ok], self.edits[last][ok]))
                begun[words] = -1
                live, state = live[~done], state[~done]
            state = self.table[state, classes[starts[live] + i]]
            alive = state > 0
            live, state = live[alive], state[alive]
            found = self.begin[state]
            begun[live] = np.where(found >= 0, found, begun[live])
            i += 1
        rest = np.flatnonzero(begun >= 0)
        hits.append((rest, begun[rest], np.zeros(len(rest), np.int8)))
        word, entry, edits = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.argsort(word, kind="stable")
        return word[order], entry[order], edits[order]


def quoted(data: np.ndarray, words: tokens.Words, row: int, word: int, window: int) -> bool:
    """Whether quotation marks open before and close behind a word, within a window of words of its row."""
    first, last = int(words.rows[row]), int(words.rows[row + 1]) - 1
    lo, hi = max(first, word - window), min(last, word + window)
    begin = int(words.ends[lo - 1]) if lo > first else int(words.off[row])
    end = int(words.starts[hi + 1]) if hi < last else int(words.off[row + 1])
    before = data[begin : int(words.starts[word])].tobytes().decode("utf-8", "ignore")
    behind = data[int(words.ends[word]) : end].tobytes().decode("utf-8", "ignore")
    opened = before.count('"') % 2 == 1 or before.rfind("“") > before.rfind("”") or before.rfind("«") > before.rfind("»")
    return opened and any(c in behind for c in '"”»')


N_FEATURES = 9


class Scorer:
    """Lexicon, automaton and regression."""

    def __init__(self, entries: list[str], weights: np.ndarray):
        self.automaton = Automaton(entries)
        self.weights = weights
        self.prefix = np.array([e.endswith("*") for e in entries], dtype=bool)
        self.mean, self.scale, self.beta, self.bias = np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0

    def features(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Features of each row; and its counts of plain, misspelled and quoted hits."""
        n = len(column)
        x, counts = np.zeros((n, N_FEATURES)), np.zeros((n, 3), np.int64)
        data, off = tokens.text_buffers(column)
        for first, last, words in tokens.pieces_of(without_marks(data), off, "alnum"):
            raw = data[off[first] : off[last]]
            size = np.diff(words.rows)
            rows = slice(first, last)
            if len(words.starts) and len(self.weights):
                codes, before = char_codes(words.data)
                starts, ends = before[words.starts], before[words.ends]
                own = np.arange(len(starts))
                inner = np.flatnonzero(unspaced(codes))
                if len(inner):
                    # a word goes on from each letter of a script without spaces
                    of = np.searchsorted(starts, inner, side="right") - 1
                    held = (of >= 0) & (inner < ends[of]) & (inner > starts[of])
                    starts, ends, own = np.concatenate([starts, inner[held]]), np.concatenate([ends, ends[of[held]]]), np.concatenate([own, of[held]])
                word, entry, edits = self.automaton.run(codes, starts, ends)
                word = own[word]
                row = np.searchsorted(words.rows, word, side="right") - 1
                cited = np.array([quoted(raw, words, int(r), int(w), WINDOW) for r, w in zip(row, word, strict=True)], dtype=bool)
                k = last - first
                weight = self.weights[entry]
                whole = ~self.prefix[entry]
                add = lambda mask, v=None: np.bincount(row[mask], minlength=k, weights=None if v is None else v[mask])  # noqa: E731, B023
                plain, fuzzy = whole & ~cited & (edits == 0), whole & ~cited & (edits > 0)
                begun = ~whole & ~cited
                x[rows, 0] = np.log1p(add(plain, weight))
                x[rows, 1] = np.log1p(add(fuzzy, weight))
                x[rows, 2] = np.log1p(add(cited, weight))
                x[rows, 3] = np.log1p(add(begun, weight))
                x[rows, 4] = np.log1p(1000 * add(plain | fuzzy) / np.maximum(1, size))
                x[rows, 5] = np.log1p(1000 * add(begun) / np.maximum(1, size))
                most = np.zeros(k)
                np.maximum.at(most, row[~cited], weight[~cited])
                x[rows, 6] = most
                pairs = np.unique(np.stack([row, entry]), axis=1) if len(row) else np.zeros((2, 0), np.int64)
                x[rows, 7] = np.log1p(np.bincount(pairs[0], minlength=k))
                counts[rows] = np.stack([add(plain | begun), add(fuzzy), add(cited)], axis=1)
            x[rows, 8] = np.log1p(size)
        return x, counts

    def fit(self, x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> None:
        """Logistic regression with a ridge, by Newton's method; ``importance`` undoes the sampling of the classes."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = 1
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        beta = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], 0.3)
        ridge[-1] = 1e-3
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            gradient = z.T @ (importance * (p - y)) + ridge * beta
            hessian = (z * (importance * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
            move = np.linalg.solve(hessian, gradient)
            beta = beta - np.clip(move, -2, 2)
            if np.abs(move).max() < 1e-8:
                break
        self.beta, self.bias = beta[:-1], float(beta[-1])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.beta + self.bias, -30, 30)))


#: Words as the scorer cuts them: letters with their marks, no digits, no punctuation.
TERM = re.compile(r"[^\x00-\x40\x5b-\x60\x7b-\x7f\u00a0-\u00bf\u2000-\u206f]+")


def _parts(text: str | None) -> set[str]:
    """Terms and, with a star, word beginnings; of scripts without spaces runs of two to four letters."""
    out = set()
    for w in set(TERM.findall((text or "").lower())):
        points = np.array([ord(c) for c in w]) if not w.isascii() else np.zeros(0, np.int64)
        if len(points) and unspaced(points).any():
            out.update(w[i : i + k] + "*" for k in (2, 3, 4) for i in range(len(w) - k + 1) if unspaced(points[i : i + k]).all())
        elif 4 <= len(w) <= 30:
            out.add(w)
            out.update(w[:k] + "*" for k in range(4, min(len(w), 9)))
    return out


def learn_entries(texts: list[str | None], y: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Terms and beginnings that are far likelier in toxic documents, with their log odds.

    All that stand in a hundredth of the toxic documents of the sample, and in
    three at least, and whose log odds are over 1.2, and, times the share of the
    toxic documents that hold them, tell enough.
    """
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return [], np.zeros(0)
    toxic, clean = Counter(), Counter()
    for text, label in zip(texts, y, strict=True):
        (toxic if label else clean).update(_parts(text))
    least = max(3, n1 // 100)
    found = []
    for part, a in toxic.items():
        odds = np.log((a + 0.5) / (n1 + 1)) - np.log((clean[part] + 0.5) / (n0 + 1))
        if a >= least and odds >= 1.2 and a * odds >= GAIN * n1:
            found.append((a * odds, part, odds))
    found.sort(key=lambda v: (-v[0], v[1]))
    chosen: dict[str, float] = {}
    beside: dict[str, float] = {}
    for _, part, odds in found:
        word = part.rstrip("*")
        # beginnings match exactly: a long term that one covers stays for its misspellings
        if part == word and len(word) >= FUZZY_FROM and any(word.startswith(c[:-1]) for c in chosen if c.endswith("*")):
            beside[part] = odds
            continue
        # a beginning of a chosen beginning, or what one covers, says nothing new
        if any(word.startswith(c[:-1]) or (part.endswith("*") and c.startswith(word)) for c in chosen if c.endswith("*")) or (part.endswith("*") and any(c.startswith(word) for c in chosen)):
            continue
        chosen[part] = odds
    chosen |= beside
    return list(chosen), np.array(list(chosen.values()))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def fit_scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on at most ``sample`` toxic and as many other documents that are not held out, chosen by hash."""
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit(5))
    chosen = [known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(sample) for y in (0, 1)]
    # at most two times ``sample`` ids
    ids = chosen[0].unionByName(chosen[1])
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    y = np.array([r.toxic for r in rows], dtype=np.float64)
    texts = [r.text for r in rows]
    entries, weights = learn_entries(texts, y)
    scorer = Scorer(entries, weights)
    if len(rows) and 0 < y.sum() < len(y):
        x, _ = scorer.features(pa.array(texts, pa.string()))
        share = {c: totals.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)}
        importance = np.where(y == 1, share[1], share[0])
        scorer.fit(x, y, importance * len(y) / importance.sum())
    else:
        scorer.bias = -5.0
    return scorer


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits, n_misspelled, n_quoted: one row for each row of ``docs``.

    Null and empty texts have no hits and get the score that goes with none.
    Without labels of both classes every score is the same low number. Repeated
    rows get equal scores; of repeated labels the highest is used.
    """
    scorer = fit_scorer(docs, labels, sample)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, counts = scorer.features(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scorer.score(x)), *(pa.array(counts[:, i]) for i in range(3))], names=["doc_id", "held_out", "score", "n_hits", "n_misspelled", "n_quoted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    out = arrow_map(rows, run, f"doc_id {kind}, held_out boolean, score double, n_hits long, n_misspelled long, n_quoted long")
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_hits", "n_misspelled", "n_quoted")
