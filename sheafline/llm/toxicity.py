"""Toxicity behind disguised spelling: noisy-channel decoding, then a score of the restored text.

A disguised word is a lattice: a sign that stands for letters (0, 1, 3, @, $ ...) may be each
of them or itself, a letter that stands three times or more is once or twice, and each separator
between letters that stand alone joins them or is an edge of a word. Viterbi finds the best path under a character language model
(four letters, counts of all documents) and the price of each disguise. Only words that
could be disguised have a lattice; all others are their own only path.

The score: features of the restored text are its words and the words' beginnings. Documents with
a label count them, by label; the features that speak for label 1 are weighed by
logistic regression on a bounded sample of labelled documents.

Nulls and odd input: a null or empty text has no features and gets the score of that; a
document without a label teaches nothing, one with several counts for each; rows that
repeat an identifier are scored each; without any labels the score is 0.5; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common
from sheafline.llm.words import Words, mix, unmix

# Signs and the letters they stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}

#: Natural logs of what a disguise costs.
PRICE_SIGN, PRICE_REPEAT = -2.0, -1.0
#: And what a word edge costs at a separator between single letters, where it is as short as the run's shortest.
PRICE_EDGE = -1.0
#: Letters of the language model: a to z, an edge of a word, and any other letter.
EDGE, OTHER, LETTERS = 26, 27, 28
ORDER = 4
GRAMS = LETTERS**ORDER

#: Beginnings of words of these lengths are features.
BEGINNINGS = (4, 5, 6)
#: Features are counted in so many buckets of their hashes first, and by themselves in the best of these.
BUCKETS = 1 << 18
GOOD_BUCKETS = 4096
#: Features that may get a weight, and documents of each label, about, that the weights are fitted on.
CANDIDATES = 400
SAMPLE = 20_000
#: Labelled documents, about, that are learned from at most; chosen by hash of the identifier.
LABELLED = 400_000

STRIP = "\"'.,;:?()[]{}<>-_/\\"
#: A word with a sign, or with a letter that stands three times, may be disguised.
DISGUISED = re.compile("[" + re.escape("".join(STANDS_FOR)) + r"]|([^\W\d_])\1\1")
#: A run of three or more single letters (or signs), with one or two separators between them.
SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+*])(?:[\x20.\-_]{1,2}(?:[^\W_]|[@$!|+*])){2,}(?![^\W_])")


def letter(c: str) -> int:
    i = ord(c) - 97
    return i if 0 <= i < 26 else OTHER


_LETTER = np.full(0x10000, OTHER, np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[65:91] = np.arange(26)
_IS_WORD = np.zeros(0x10000, bool)
for _c in range(0x10000):
    _IS_WORD[_c] = not 0xD800 <= _c < 0xE000 and unicodedata.category(chr(_c))[0] in "LM"


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of runs of four letters, edges of words included, in one array operation for all texts."""
    joined = "  ".join(t for t in texts if t)
    codes = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    counts = np.zeros(GRAMS, np.int64)
    for at in range(0, len(codes), 1 << 22):
        part = codes[at : at + (1 << 22)]
        inside = _IS_WORD[part]
        line = np.where(inside, _LETTER[part], EDGE)
        # Several edges in a row are one; three stand before a word for the model's first letters.
        keep = inside | np.concatenate([[True], inside[:-1]])
        line = line[keep]
        n = 1 + (line == EDGE) * 2
        line = np.repeat(line, n)
        if len(line) < ORDER:
            continue
        code = line[: -ORDER + 1]
        for k in range(1, ORDER):
            code = code * LETTERS + line[k : len(line) - ORDER + 1 + k]
        counts += np.bincount(code, minlength=GRAMS)
    return counts


class LanguageModel:
    """log P(letter | three letters), each order mixed with the one below it by its count."""

    def __init__(self, counts: np.ndarray):
        c = counts.astype(np.float64).reshape((LETTERS,) * ORDER)
        p = np.full(LETTERS, 1 / LETTERS)
        for order in range(1, ORDER + 1):
            own = c.sum(axis=tuple(range(ORDER - order))) if order < ORDER else c
            total = own.sum(axis=-1, keepdims=True)
            p = (own + 5 * p) / (total + 5)
        self.log = np.log(p).astype(np.float32)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Choices for each run of equal characters: ((text, price) ...) per place."""
    places = []
    i = 0
    while i < len(word):
        j = i
        while j < len(word) and word[j] == word[i]:
            j += 1
        c, n = word[i], j - i
        letters = STANDS_FOR.get(c)
        if letters and not c.isalpha():
            # A run of one sign is one disguise; three and more are rather a decoration.
            choices = [(x, PRICE_SIGN + PRICE_REPEAT * (n > 1)) for x in letters]
            if n > 1:
                choices += [(x * 2, PRICE_SIGN + PRICE_REPEAT * (n > 2)) for x in letters]
            choices.append((c * n, (2 * PRICE_SIGN, PRICE_SIGN)[n - 1] if n < 3 else 0.0))
        elif n > 1 and c.isalpha():
            # Two of a letter are common spelling, three are not.
            choices = [(c * 2, PRICE_REPEAT), (c, PRICE_REPEAT)] if n > 2 else [(c * 2, 0.0)]
        else:
            choices = [(c * n, 0.0)]
        places.append(choices)
        i = j
    return places


class Trail:
    """What the paths of a search have written, as back pointers in a flat list. As soon as all live paths agree on a
    beginning, it is written out and forgotten, so a search holds the stretch on which they still differ."""

    EVERY = 2048

    def __init__(self):
        self.nodes: list[tuple[int, str]] = []
        self.done: list[str] = []
        self.next = self.EVERY

    def add(self, before: int, piece: str) -> int:
        if not piece:
            return before
        self.nodes.append((before, piece))
        return len(self.nodes) - 1

    def back(self, node: int) -> list[int]:
        out = []
        while node >= 0:
            out.append(node)
            node = self.nodes[node][0]
        return out

    def shorten(self, live: list[int]) -> dict[int, int]:
        """New numbers of the live nodes."""
        ways = [self.back(n)[::-1] for n in set(live)]
        shared = 0
        while all(len(w) > shared and w[shared] == ways[0][shared] for w in ways):
            shared += 1
        self.done.extend(self.nodes[n][1] for n in ways[0][:shared])
        kept, new = sorted({n for w in ways for n in w[shared:]}), {-1: -1}
        gone = set(ways[0][:shared])
        new.update(dict.fromkeys(gone, -1))
        nodes = []
        for n in kept:
            new[n] = len(nodes)
            nodes.append((new[self.nodes[n][0]], self.nodes[n][1]))
        self.nodes = nodes
        # Where paths don't agree the next look comes later, so that looks stay a share of the work.
        self.next = max(self.EVERY, 2 * len(nodes))
        return new

    def text(self, node: int) -> str:
        return "".join(self.done) + "".join(self.nodes[n][1] for n in reversed(self.back(node)))


def viterbi(word: str, model: LanguageModel) -> str:
    """The best reading of a word; states are the last three letters."""
    log, trail = model.log, Trail()
    states: dict[tuple[int, int, int], tuple[float, int]] = {(EDGE, EDGE, EDGE): (0.0, -1)}
    for choices in lattice(word):
        after: dict[tuple[int, int, int], tuple[float, int, str]] = {}
        for state, (score, text) in states.items():
            for piece, price in choices:
                s, total = state, score + price
                for ch in piece:
                    k = letter(ch)
                    total += float(log[s[0], s[1], s[2], k])
                    s = (s[1], s[2], k)
                if s not in after or total > after[s][0]:
                    after[s] = (total, text, piece)
        states = {s: (v, trail.add(text, piece)) for s, (v, text, piece) in after.items()}
        if len(trail.nodes) > trail.next:
            new = trail.shorten([t for _, t in states.values()])
            states = {s: (v, new[t]) for s, (v, t) in states.items()}
    ends = {s: (v + float(log[s[0], s[1], s[2], EDGE]), t) for s, (v, t) in states.items()}
    best = max(v for v, _ in ends.values())
    return max(trail.text(t) for v, t in ends.values() if v == best)


SEPARATOR = re.compile(r"[\x20.\-_]+")


def spaced(run: str, model: LanguageModel) -> list[str]:
    """The words of the best reading of a run of single letters: each separator joins its letters or is a word's edge.

    A part is one, two, or three and more equal letters that are joined, with the choices of `lattice`; parts of equal
    letters meet at edges only. States are the last three letters, and how a part of three goes on: not (0),
    without a trace (1), or as it stands (2).
    """
    log = model.log
    letters, gaps = SEPARATOR.split(run), [len(g) for g in SEPARATOR.findall(run)]
    least = min(gaps)
    edge_price = [PRICE_EDGE if g == least else 0.0 for g in gaps]
    trail = Trail()
    best: list[dict[tuple, tuple]] = [{} for _ in range(len(letters) + 1)]
    best[0][EDGE, EDGE, EDGE, 0] = (0.0, -1)

    def put(at: int, state: tuple, score: float, text: int, pieces: tuple[str, ...], goes_on: int) -> None:
        s = state
        for ch in pieces[-1]:
            k = letter(ch)
            score += float(log[s[0], s[1], s[2], k])
            s = (s[1], s[2], k)
        key = (*s, goes_on)
        if key not in best[at] or score > best[at][key][0]:
            for piece in pieces:
                text = trail.add(text, piece)
            best[at][key] = (score, text)

    for i, c in enumerate(letters):
        if len(trail.nodes) > trail.next:
            # Parts are of three letters at most, so nothing further on is written yet.
            open_ = range(i, min(i + 4, len(best)))
            new = trail.shorten([t for k in open_ for _, t in best[k].values()])
            for k in open_:
                best[k] = {s: (v, new[t]) for s, (v, t) in best[k].items()}
        longest = next((n for n in (1, 2) if letters[i + n : i + n + 1] != [c]), 3)
        parts = [(n, lattice(c * n)[0]) for n in range(1, longest + 1)]
        for (*state, goes_on), (score, text) in best[i].items():
            state = tuple(state)
            ways = []
            if i == 0 or c != letters[i - 1]:
                ways.append((state, score, ()))
            elif goes_on:
                put(i + 1, state, score, text, (c if goes_on == 2 else "",), goes_on)
            if i:
                end = score + float(log[(*state, EDGE)]) + edge_price[i - 1]
                ways.append(((EDGE, EDGE, EDGE), end, (" ",)))
            for from_state, total, before in ways:
                for n, choices in parts:
                    for piece, price in choices:
                        put(i + n, from_state, total + price, text, (*before, piece), (n > 2) + (piece == c * 3))
        best[i] = {}
    ends = [(v + float(log[s[0], s[1], s[2], EDGE]), t) for s, (v, t) in best[-1].items()]
    return trail.text(max(ends, key=lambda x: x[0])[1]).split(" ")


class Restorer:
    """Restores texts; remembers words, as disguises repeat."""

    def __init__(self, model: LanguageModel):
        self.model, self.known, self.runs = model, {}, {}

    def word(self, word: str) -> str:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            core = word.strip(STRIP)
            found = viterbi(core, self.model) if core and any(c.isalpha() for c in core) else word
            self.known[word] = found
        return found

    def spaced(self, run: str) -> str:
        """The words that a run of single letters makes; letters that stay alone are in the text already."""
        found = self.runs.get(run)
        if found is None:
            if not any(c.isalpha() for c in run):
                return self.word(SEPARATOR.sub("", run))
            if len(self.runs) > 100_000:
                self.runs.clear()
            found = self.runs[run] = " ".join(w for w in spaced(run, self.model) if len(w) > 1)
        return found

    def __call__(self, text: str) -> str:
        """The text in lower case; disguised words are put right, their readings in place."""
        return self.all([text])[0]

    def all(self, texts: list[str]) -> list[str]:
        """The texts, each restored. Where a word or a run may be disguised is looked for in many texts at once."""
        out, texts, at = [], [t.lower() for t in texts], 0
        upto = np.cumsum([len(t) + 1 for t in texts])
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP_LETTERS, "right")))
            out += self._step(texts[at:to])
            at = to
        return out

    def _step(self, texts: list[str]) -> list[str]:
        joined = "\n".join(texts)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        words, runs = suspects(joined)
        pieces: dict[int, list[str]] = {}
        done: dict[int, int] = {}
        for row, start, end in zip((np.searchsorted(first, words[0], "right") - 1).tolist(), *(x.tolist() for x in words), strict=True):
            word = joined[start:end]
            if (word in self.known or DISGUISED.search(word)) and (found := self.word(word)) != word:
                pieces.setdefault(row, []).extend((joined[done.get(row, first[row]) : start], found))
                done[row] = end
        out = list(texts)
        for row, parts in pieces.items():
            out[row] = "".join(parts) + joined[done[row] : first[row + 1] - 1]
        for row in np.unique(np.searchsorted(first, runs, "right") - 1).tolist():
            extra = [words for m in SPACED.finditer(texts[row]) if (words := self.spaced(m.group()))]
            if extra:
                out[row] = " ".join([out[row], *extra])
        return out


#: Letters that are looked through in one step; bounds the arrays for each letter.
STEP_LETTERS = 1 << 21
_ALL = [chr(c) for c in range(0xFFFF)] + [""]
_SPACE = np.array([c.isspace() for c in _ALL])
_SIGN = np.array([c != "" and c in STANDS_FOR for c in _ALL])
# The last place is for all letters from U+FFFF on, which may be anything but white space.
_MAY_REPEAT = np.array([c.isalpha() or not c for c in _ALL])
_WORD = np.array([c.isalnum() for c in _ALL])
_SINGLE = np.array([c.isalnum() or c in "@$!|+*" for c in _ALL])
_BETWEEN = np.array([c != "" and c in " .-_" for c in _ALL])


def suspects(text: str) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Start and end of all words of a text that may be disguised, and places in all runs of single letters, and in a few
    that are none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.minimum(codes, 0xFFFF)
    hit = _SIGN[c]
    same = codes[1:] == codes[:-1]
    hit[2:] |= same[1:] & same[:-1] & _MAY_REPEAT[c[2:]]
    hit = np.flatnonzero(hit)
    edge = np.concatenate([[-1], np.flatnonzero(_SPACE[c]), [len(c)]])
    after = np.unique(np.searchsorted(edge, hit))
    # The second letter of a run: the first one, which no letter stands before, is one or two separators away, as is the third.
    between, single = np.zeros(len(c) + 8, bool), np.zeros(len(c) + 8, bool)
    between[4:-4], single[4:-4] = _BETWEEN[c], _SINGLE[c]
    begins = single.copy()
    begins[5:-3] &= ~_WORD[c]
    n = len(c)
    of = lambda x, k: x[4 + k : 4 + k + n]
    left = of(between, -1) & (of(begins, -2) | of(between, -2) & of(begins, -3))
    right = of(between, 1) & (of(single, 2) | of(between, 2) & of(single, 3))
    return (edge[after - 1] + 1, edge[after]), np.flatnonzero(left & of(single, 0) & right)


_EDGES = np.zeros(256, bool)
_EDGES[[ord(c) for c in STRIP + "!*&%#$|"]] = True


def sources(wanted: np.ndarray) -> np.ndarray:
    """Words' and beginnings' hashes out of which the wanted features can come: themselves, or as they stand twice or three times."""
    once = unmix(wanted)
    return np.unique(np.concatenate([wanted, *(once - np.uint64(n) for n in (2, 3))]))


def one_of(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are among the sorted `wanted`, few of them; most others are told by their last 16 bits."""
    table = np.zeros(1 << 16, bool)
    table[wanted & np.uint64(0xFFFF)] = True
    out = table[values & np.uint64(0xFFFF)]
    some = np.flatnonzero(out)
    at = np.minimum(np.searchsorted(wanted, values[some]), len(wanted) - 1)
    out[some] = wanted[at] == values[some]
    return out


def features(texts: list[str], only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct features of restored texts, by row: words without marks around them,
    beginnings of words (of whole characters), and either of these that the text has twice or three times. With `only`,
    those that come out of these `sources`."""
    column = pa.array([t.replace("\x00", " ") for t in texts], pa.large_string())
    words = Words(column)
    start, end = words.start.copy(), words.end.copy()
    for _ in range(4):
        if not len(start):
            break
        start += (end - start > 1) & _EDGES[words.data[start]]
        end -= (end - start > 1) & _EDGES[words.data[end - 1]]
    words.start, words.end = start, end
    rows, found = [words.row], [words.hashes(0)]
    lead = (words.data & 0xC0) != 0x80
    place = np.concatenate([[0], np.cumsum(lead)])
    at = np.concatenate([np.flatnonzero(lead), [len(words.data)] * 8])
    for n in BEGINNINGS:
        longer = np.flatnonzero(place[end] - place[start] > n)
        words.start, words.end = start[longer], at[place[start[longer]] + n]
        rows.append(words.row[longer])
        found.append(mix(words.hashes(1) + np.uint64(n)))
    row, found = np.concatenate(rows), np.concatenate(found)
    if only is not None:
        kept = one_of(found, only) if len(only) else np.zeros(len(found), bool)
        row, found = row[kept], found[kept]
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    times = np.diff(np.append(np.flatnonzero(new), len(row)))
    row, found = row[new], found[new]
    # A word that a text has by chance it seldom has again: two and three times are features of their own.
    parts = [(row, found)]
    parts += [(row[times >= n], mix(found[times >= n] + np.uint64(n))) for n in (2, 3)]
    row, found = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], found[order]


def model_of(docs: DataFrame) -> LanguageModel:
    """Counts of all texts. A task gives a row for each run it met; there are at most LETTERS^4 of them."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(GRAMS, np.int64)
        for b in batches:
            counts += gram_counts(b.column(0).to_pylist())
        gram = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(counts[gram])], names=["gram", "n"])

    made = docs.select("text").mapInArrow(task, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = made.toArrow()
    counts = np.zeros(GRAMS, np.int64)
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return LanguageModel(counts)


class Classifier:
    """Weights of some features, and what a text has without them."""

    def __init__(self, feature: np.ndarray, weight: np.ndarray, bias: float):
        order = np.argsort(feature)
        self.feature, self.weight, self.bias = feature[order], weight[order], bias
        self.sources = sources(self.feature)

    def scores(self, texts: list[str]) -> np.ndarray:
        row, found = features(texts, self.sources)
        total = np.full(len(texts), self.bias)
        if len(self.feature):
            at = np.minimum(np.searchsorted(self.feature, found), len(self.feature) - 1)
            hit = self.feature[at] == found
            total += np.bincount(row[hit], self.weight[at[hit]], len(texts))
        return 1 / (1 + np.exp(-total))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 300, l1: float = 2e-3) -> tuple[np.ndarray, float]:
    """Logistic regression with weights of at least 0 and an L1 penalty, by projected gradients with momentum.

    Both labels weigh alike. The features all speak for label 1, and negative weights would
    let the other words of a long text outvote them.
    """
    w, b = np.zeros(x.shape[1], np.float32), np.float32(-2.0)
    per = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    vw, vb, rate = np.zeros_like(w), 0.0, 4.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = (p - y) * per
        vw = 0.9 * vw - rate * (x.T @ g + l1)
        vb = 0.9 * vb - rate * float(g.sum())
        w, b = np.clip(w + vw, 0, 12).astype(np.float32), np.float32(b + vb)
        vw[w == 0] = np.maximum(vw[w == 0], 0)
    return w, float(b)


def fit(labelled: DataFrame, model, candidates: int = CANDIDATES, sample: int = SAMPLE) -> Classifier:
    """`labelled` has text and label (0, 1). All of it is counted: first by bucket of the features' hashes, then
    the features of the buckets that tell the labels apart best. Weights are fitted on at most `sample` documents
    of each label."""

    def labelled_features(b: pa.RecordBatch, restore: Restorer, only: np.ndarray | None = None):
        row, found = features(restore.all([t or "" for t in b.column(0).to_pylist()]), only)
        return row, found, np.array(b.column(1).to_pylist(), np.int64)

    def count_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.value)
        counts = np.zeros((2, BUCKETS), np.int64)
        docs = np.zeros(2, np.int64)
        for b in batches:
            row, found, label = labelled_features(b, restore)
            bucket = (found % np.uint64(BUCKETS)).astype(np.int64)
            for k in (0, 1):
                counts[k] += np.bincount(bucket[label[row] == k], minlength=BUCKETS)
                docs[k] += int((label == k).sum())
        used = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), *(pa.array(np.append(counts[k][used], docs[k])) for k in (0, 1))],
            names=["feature", "n0", "n1"],
        )

    rows = labelled.select("text", "label")
    kind = "feature long, n0 long, n1 long"
    sums = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1")]
    # At most BUCKETS rows and one.
    made = rows.mapInArrow(count_buckets, kind).groupBy("feature").agg(*sums).toArrow()
    bucket, n0, n1 = (made.column(c).to_numpy() for c in ("feature", "n0", "n1"))
    all0, all1 = int(n0[bucket == -1].sum()), int(n1[bucket == -1].sum())
    none = Classifier(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    if not all0 or not all1:
        return none

    def lift(n0, n1):
        """How far apart a feature's shares are, in standard errors of an even split."""
        a, b = n1 / all1, n0 / all0
        return (a - b) / np.sqrt(a + b + 1e-12)

    least = max(2, all1 // 1000)
    told = lift(n0, n1) * ((bucket >= 0) & (n1 >= least))
    good = np.sort(bucket[np.argsort(-told, kind="stable")[:GOOD_BUCKETS]])

    def count_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.value)
        for b in batches:
            row, found, label = labelled_features(b, restore)
            hit = np.isin((found % np.uint64(BUCKETS)).astype(np.int64), good)
            key, place = np.unique(found[hit], return_inverse=True)
            own = label[row[hit]]
            part = [np.bincount(place[own == k], minlength=len(key)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), *(pa.array(x.astype(np.int64)) for x in part)],
                names=["feature", "n0", "n1"],
            )

    each = rows.mapInArrow(count_features, kind).groupBy("feature").agg(*sums).filter(F.col("n1") >= least)
    a, z = F.col("n1") / all1, F.col("n0") / all0
    each = each.withColumn("lift", (a - z) / F.sqrt(a + z)).filter("lift > 0")
    best = each.orderBy(F.desc("lift"), "feature").limit(candidates).collect()
    chosen = np.sort(np.array([r.feature for r in best], np.int64).view(np.uint64))
    if not len(chosen):
        return none

    only = sources(chosen)

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.value)
        for b in batches:
            row, found, label = labelled_features(b, restore, only)
            at = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
            hit = chosen[at] == found
            bounds = np.searchsorted(row[hit], np.arange(b.num_rows + 1)).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(bounds), pa.array(at[hit], pa.int64()))
            yield pa.RecordBatch.from_arrays([own, pa.array(label, pa.int64())], names=["own", "label"])

    share = F.when(F.col("label") == 1, min(1.0, sample / all1)).otherwise(min(1.0, sample / all0))
    taken = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share * 1_000_003)
    taken = taken.mapInArrow(pick, "own array<long>, label long").toArrow()
    y = taken.column("label").to_numpy()
    x = np.zeros((len(y), len(chosen)), np.float32)
    for i, f in enumerate(taken.column("own")):
        x[i, f.as_py()] = 1
    w, b = logistic(x, y.astype(np.float32))
    return Classifier(chosen[w > 0], w[w > 0].astype(np.float64), b)


def score(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, score) of every row of `docs`, mark a hash of the text; `labelled` has text and label. Without documents
    of both labels, or features that tell them apart, every score is 0.5."""
    return scored(docs, labelled, id_col, text_col)[0]


def scored(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, bool]:
    """The scores, and whether anything was learned."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = common.marked(docs, id_col, text_col)
    model = spark.sparkContext.broadcast(model_of(rows))
    classifier = spark.sparkContext.broadcast(fit(labelled, model))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model.value)
        for b in batches:
            found = classifier.value.scores(restore.all([t or "" for t in b.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found)], names=["doc_id", "mark", "score"])

    return rows.mapInArrow(task, "doc_id long, mark long, score double"), bool(len(classifier.value.feature))


def learning_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of the documents with a label, less the held-out ones: crc32 of the id mod 4 is 2.

    At most about LABELLED labels are used, so they go to the tasks and no text is shuffled."""
    known = labels.filter(common.remainder_of_id(F.col("doc_id"), 4) != 2).filter("toxic in (0, 1)")
    known = common.about(known, LABELLED, "doc_id").select("doc_id", F.col("toxic").cast("int").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label")


#: Documents with this score or a higher one are toxic.
REJECT = 0.3


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` with a score below REJECT; all of them where the labels taught nothing."""
    found, learned = scored(docs, learning_rows(docs, labels))
    return common.without(docs, found.filter(F.col("score") >= REJECT), "toxic") if learned else docs


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of each document."""
    docs = common.documents(spark, sf_dir)
    found = score(docs, learning_rows(docs, common.read(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        (common.remainder_of_id(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )
