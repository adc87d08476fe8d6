"""Toxicity by noisy-channel deobfuscation.

A toxic word may be written with look-alike characters, repeated letters,
separators or spaces between its letters. The channel is a lattice: at each
character the alternatives of what was meant (a letter for a look-alike, one
or two letters for a run, nothing for a separator or a space), each with a
cost. A Viterbi search over the last two letters finds the most likely reading
under a character trigram model learned from the corpus. Words that are plainly
written so are replaced by their reading. Any other word with a letter that has
more than one reading (a doubled letter, a look-alike at any place) counts both
as it stands and as read, so ordinary words with double letters stay what they
are; a word of digits alone is a number. Three single letters or more in a row
on one line, any number of spaces apart, are read as one.

Where only given features count (those of a fitted lexicon), a word is searched
for its reading if some path through its lattice could hold one of them; the
letters a character may stand for and the dropped ones decide that.

The restored words are scored with a lexicon learned from labelled documents:
a logistic regression over word and prefix features with non-negative weights
and both penalties, so a word that only keeps company with toxic words gets no weight.

The trigram counts cover all documents outside the held-out fold. The lexicon
is fitted on at most ``LABELLED_ROWS`` labelled rows, chosen by hash, and looks
at no more than ``LEXICON`` features; both bounds are parameters of the model.

Defined cases
* null or empty text: the score of a text without any lexicon word
* rows that repeat score alike; a null id or a label without document is no training row
* several labels for one id: the largest counts
* no labelled rows: an empty lexicon, every text scores 0.0003
* no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, documents, fold, labels
from salesmart.llm.words import span_hashes, text_bytes, text_parts, word_spans

FOLDS, HELD_OUT = 3, 1
LABELLED_ROWS = 60_000
LEXICON = 50_000
THRESHOLD = 0.7
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäæçèéêëìíîïñòóôöùúûüýßœ"
PREFIXES = (4, 5)
#: Letters that a look-alike may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = ".-_~·'"
_SIZE = len(LETTERS) + 2  # 0: word boundary, last: anything that spoils a count
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_SPOILED = _SIZE - 1
SPACED = 3  # single letters or look-alikes in a row that make a spaced word


def _symbols() -> np.ndarray:
    """Symbol of each code point below 0x10000; letters of other scripts spoil a count."""
    table = np.zeros(0x10000, np.int64)
    for code in range(0x80, 0x10000):
        if chr(code).isalnum():
            table[code] = _SPOILED
    for c in [*LOOKALIKES, *"0123456789_~"]:
        table[ord(c)] = _SPOILED
    for c, i in _CODE.items():
        table[ord(c)] = i
        if len(c.upper()) == 1:
            table[ord(c.upper())] = i
    return table


def trigram_counts(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Counts of symbol triples (flat), without those that hold a spoiled symbol or no letter."""
    codes = np.frombuffer(("  ".join(["", *texts, ""])).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = table[np.minimum(codes, 0xFFFF)]
    out = np.zeros(_SIZE ** 3, np.int64)
    for at in range(0, max(len(s) - 2, 0), 1 << 20):
        w = s[at:at + (1 << 20) + 2]
        a, b, c = w[:-2], w[1:-1], w[2:]
        fine = (a != _SPOILED) & (b != _SPOILED) & (c != _SPOILED) & ((b > 0) | (c > 0))
        out += np.bincount((a[fine] * _SIZE + b[fine]) * _SIZE + c[fine], minlength=len(out))
    return out


def learn_trigrams(docs: DataFrame) -> np.ndarray:
    """Log probabilities [a, b, c] of a symbol after two others, from all rows."""
    def run(batches):
        table, total = _symbols(), np.zeros(_SIZE ** 3, np.int64)
        for batch in batches:
            for part in text_parts(batch):
                total += trigram_counts([t for t in part.column("text").to_pylist() if t], table)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["triple", "n"])
    rows = docs.select("text").mapInArrow(run, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_SIZE ** 3)  # as many rows as there are triples of symbols at most
    for r in rows:
        counts[r["triple"]] = r["n"]
    tri = counts.reshape(_SIZE, _SIZE, _SIZE)
    two, one = tri.sum(0), tri.sum((0, 1))
    # a word's first letter follows two boundaries, whatever stood before them
    p1 = (one + 0.5) / (one + 0.5).sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (tri + 5 * p2) / (tri.sum(2, keepdims=True) + 5)
    p3[:, 0, :] = p2[0]
    return np.log(p3)


@dataclass
class Channel:
    """Costs (natural logarithm) of the ways a character may have been written."""
    lookalike: float = math.log(0.3)
    dropped: float = math.log(0.3)
    doubled: float = math.log(0.4)
    single: float = math.log(0.6)
    kept_space: float = math.log(0.5)
    lost_space: float = math.log(0.5)
    wildcard: float = math.log(1 / len(LETTERS))


@dataclass
class Reader:
    """Restores what a noisy word or a row of single letters was meant to say."""
    logp: np.ndarray
    channel: Channel = field(default_factory=Channel)

    def lattice(self, word: str) -> list[list[tuple[tuple[int, ...], float]]]:
        """Alternatives (symbols, cost) of each run of one character."""
        c, out = self.channel, []
        for m in re.finditer(r"(.)\1*", word, re.DOTALL):
            ch, n = m[1], len(m[0])
            letters = [(_CODE[ch], 0.0)] if ch in _CODE else [(_CODE[x], c.lookalike) for x in LOOKALIKES.get(ch, "")]
            edges = []
            for code, cost in letters:
                if n == 1:
                    edges.append(((code,), cost))
                elif n == 2:
                    edges += [((code, code), cost + c.single), ((code,), cost + c.doubled)]
                else:
                    edges += [((code,), cost + c.single), ((code, code), cost + c.doubled)]
            if ch == " ":
                edges += [((0,), c.kept_space), ((), c.lost_space)]
            elif ch == "*" and n == 1:
                edges += [((code,), c.wildcard) for code in range(1, _SPOILED)]
            elif not letters or not ch.isalnum():
                edges.append(((), c.dropped))
            out.append(edges)
        return out

    def read(self, word: str) -> list[str]:
        """The words of the most likely reading."""
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for edges in [*self.lattice(word), [((0,), 0.0)]]:
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in states.items():
                for symbols, cost in edges:
                    x, y, total, way = a, b, score + cost, path
                    for s in symbols:
                        total += self.logp[x, y, s]
                        x, y, way = (0 if s == 0 else y), s, (way, s)
                    if (x, y) not in after or total > after[x, y][0]:
                        after[x, y] = (total, way)
            states = after
        path, symbols = max(states.values(), key=lambda v: v[0])[1], []
        while path:
            path, s = path
            symbols.append(s)
        return "".join(" " if s == 0 else LETTERS[s - 1] for s in reversed(symbols)).split()


class _Bones(dict):
    """Letters of a word by class (i and l, which share look-alikes, are one); what is never read as a letter is left out."""

    def __missing__(self, code):
        return None


_CLASS = str.maketrans("l", "i")
_BONES = _Bones({ord(c): c.translate(_CLASS) for c in LETTERS} |
                {ord(c): means[0] for c, means in LOOKALIKES.items() if c.isalnum()})
_RUN = re.compile(r"(.)\1+", re.DOTALL)
#: Characters that are read as a letter or dropped, or as any letter.
_OPEN = re.compile("[" + re.escape("".join(c for c in LOOKALIKES if not c.isalnum()) + "*") + "]")


def bones(word: str) -> str:
    """Classes of a word's letters, runs as one: the same for the word and all readings, if no character of it is open."""
    return _RUN.sub(r"\1", word.translate(_BONES))


_CLASSES, _OPEN_BYTE = 27, 27  # a to z; 0: never read as a letter, or no letter


def _byte_classes() -> np.ndarray:
    """Class of each byte of a text in UTF-8; bytes of other than ASCII characters are open."""
    table = np.zeros(256, np.uint8)
    table[0x80:] = _OPEN_BYTE
    for code in range(0x80):
        c = chr(code).lower()
        table[code] = _OPEN_BYTE if _OPEN.match(c) else ord(_BONES[ord(c)]) - 0x60 if ord(c) in _BONES else 0
    return table


class Wanted:
    """Whether a word as it stands, or a reading of it, may have one of the given features."""

    def __init__(self, names):
        names = list(names)
        # by the first three bones: a word has them in common with its features and its readings
        self.classes, self.begins = _byte_classes(), np.zeros((_CLASSES,) * 3, bool)
        for n in names:
            first = [ord(c) - 0x60 for c in bones(n.removesuffix("*"))[:3]]
            if all(c < _CLASSES for c in first):  # words with another letter among them are not told apart
                pad = 3 - len(first)
                self.begins[(*first, *[slice(None) if n.endswith("*") else 0] * pad)] = True
        # a reading has letters only, and the bones of its beginning begin its bones
        letters = [n for n in names if all(c in _CODE for c in n.removesuffix("*"))]
        self.whole = {bones(n) for n in letters if not n.endswith("*")}
        self.heads = {bones(n[:-1]) for n in letters if n.endswith("*")}
        self.lengths = sorted({len(h) for h in self.heads})

    def may_begin(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, look: int = 12) -> np.ndarray:
        """For many spans at once: false where the first bones, found in ``look`` bytes, are of no feature."""
        out = np.ones(len(starts), bool)
        begins, scale = self.begins.ravel(), _CLASSES ** np.arange(3, -1, -1)
        for at in range(0, len(starts), 1 << 16):
            place = starts[at:at + (1 << 16)]
            live, left = np.arange(at, at + len(place)), ends[at:at + (1 << 16)] - place
            key, n, last = np.zeros(len(place), np.int64), np.zeros(len(place), np.int8), np.zeros(len(place), np.uint8)
            for k in range(look):
                c = self.classes[data[place + k]]
                new = (c > 0) & (c != last)
                key, n, last = np.where(new, key * _CLASSES + c, key), n + new, np.where(new, c, last)
                known = c != _OPEN_BYTE
                done = (n == 3) | (left == k + 1)
                told = np.flatnonzero(done & known)
                out[live[told]] = begins[key[told] * scale[n[told]]]
                on = np.flatnonzero(~done & known)
                live, place, left, key, n, last = (x[on] for x in (live, place, left, key, n, last))
        return out

    def may_have(self, word: str) -> bool:
        if _OPEN.search(word):
            return True
        own = bones(word)
        return own in self.whole or any(own[:n] in self.heads for n in self.lengths)


_BLANK = re.compile(r"[\t\x0b\x0c\r]")
_TRIM = re.compile(r"^[^\w@$(]+|[^\w$!]+$")
_TRACE = re.compile(r"(.)\1|[" + re.escape("".join(LOOKALIKES) + SEPARATORS) + "*]", re.DOTALL)
_NOISE = re.compile(r"(.)\1\1|[^\W\d_][\d@$!|+(*€£._~·'-]+[^\W\d_]|^[\d@$!|(€£][^\W\d_]{2}|[^\W\d_]{2}[\d@$!€£+]$", re.DOTALL)


_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1")


def plain_or_noisy(word: str) -> tuple[str, bool]:
    """The word in lower case without outer punctuation; whether it needs a lattice."""
    word = word.lower()
    if word.isalpha():  # nothing to trim, and only a run is noise
        return word, bool(_TRIPLE.search(word))
    while (cut := _TRIM.sub("", word)) != word:
        word = cut
    if len(word) > 2 and word[-1] in "$!" and word[-2] in "$!":  # a run of symbols behind a word is decoration
        return plain_or_noisy(word.rstrip("$!"))
    return word, bool(_NOISE.search(word)) and sum(c.isalpha() for c in word) >= 2


def features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) > n]] if len(word) > 2 else []


class WordReader:
    """Restored words of whole texts, with one decision for each distinct word.

    With ``wanted``, readings that can have none of these features are left out.
    """

    def __init__(self, logp: np.ndarray, value, limit: int = 400_000, wanted=None):
        self.reader, self.value, self.limit = Reader(logp), value, limit
        self.wanted = None if wanted is None else Wanted(wanted)
        self.known: dict[int, object] = {}

    def restored(self, word: str) -> list[str]:
        word, noisy = plain_or_noisy(word)
        if noisy:
            return self.reader.read(word) if self.wanted is None or self.wanted.may_have(word) else []
        trace = _DOUBLE if word.isalpha() else _TRACE
        if (len(word) > 2 and trace.search(word) and any(c in _CODE for c in word)
                and (self.wanted is None or self.wanted.may_have(word))):
            return list(dict.fromkeys([word, *self.reader.read(word)]))
        return [word] if word else []

    def texts(self, texts: pa.Array):
        """(text number, value) of each distinct word and spaced word of each text."""
        data, offsets = text_bytes(texts)
        starts, ends, doc = word_spans(data, offsets)
        if len(self.known) > self.limit:
            self.known.clear()
        some = slice(None) if self.wanted is None else np.flatnonzero(self.wanted.may_begin(data, starts, ends))
        begin, end = starts[some], ends[some]
        unique, where, inverse = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        raw, values = data.tobytes(), []
        for h, i in zip(unique.tolist(), where.tolist(), strict=True):
            v = self.known.get(h)
            if v is None:
                v = self.known[h] = self.value(self.restored(raw[begin[i]:end[i]].decode()))
            values.append(v)
        pairs = np.unique(doc[some] * len(unique) + inverse) if len(begin) else np.zeros(0, np.int64)
        # single letters in a row, on one line, with nothing but white space between
        size = ends - starts
        one = (size == 1) | ((size == 2) & (data[starts] >= 0xC3) & (data[starts] < 0xE0))
        one &= ~((size == 1) & ~np.isin(data[starts] | 0x20, np.arange(0x61, 0x7B)) & ~np.isin(data[starts], [ord(c) for c in LOOKALIKES if ord(c) < 0x80]))
        run = np.flatnonzero(np.diff(np.concatenate([[0], one.astype(np.int8), [0]])))
        letter = one & ~((size == 1) & ((data[starts] < 0x41) | (data[starts] == 0x7C)))
        breaks = np.append(0, np.cumsum(data == 0x0A))
        apart = np.append(True, (doc[1:] != doc[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])) if len(doc) else np.zeros(0, bool)
        extra_doc, extra, read = [], [], {}
        for lo, hi in zip(run[::2].tolist(), run[1::2].tolist(), strict=True):
            at = lo
            while hi - at >= SPACED:
                to = at + 1
                while to < hi and not apart[to]:
                    to += 1
                if to - at >= SPACED:
                    said = _BLANK.sub(" ", raw[starts[at]:ends[to - 1]].decode().lower())
                    if said not in read:
                        read[said] = self.value(self.reader.read(said))
                    extra_doc.append(int(doc[at]))
                    extra.append(read[said])
                at = to
        return pairs // max(len(unique), 1), pairs % max(len(unique), 1), values, extra_doc, extra


def training_rows(docs: DataFrame, known: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """text, toxic of at most ``limit`` labelled rows outside the held-out fold, chosen by hash."""
    chosen = (known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # at most ``limit`` rows of an id and a flag
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _document_features(rows: DataFrame, logp: np.ndarray, keep: dict[str, int] | None, schema: str) -> DataFrame:
    """Per batch: label counts of all features, or per document the numbers of those in ``keep``."""
    shared = rows.sparkSession.sparkContext.broadcast((logp, keep))

    def run(batches):
        logp, keep = shared.value
        pick = (lambda f: f) if keep is None else keep.get
        own = WordReader(logp, lambda words: tuple({x for w in words for f in features(w) if (x := pick(f)) is not None}), wanted=keep)
        for batch in batches:
            for part in text_parts(batch):
                toxic = part.column("toxic").to_pylist()
                doc, word, values, extra_doc, extra = own.texts(part.column("text"))
                held: list[set] = [set() for _ in toxic]
                some = np.flatnonzero(np.array([bool(v) for v in values], bool)[word]) if len(word) else word
                for d, w in zip(doc[some].tolist(), word[some].tolist(), strict=True):
                    held[d].update(values[w])
                for d, v in zip(extra_doc, extra, strict=True):
                    held[d].update(v)
                if keep is not None:
                    yield pa.record_batch([pa.array([int(t > 0) for t in toxic], pa.int64()), part.column("copies"),
                                           pa.array([sorted(h) for h in held], pa.list_(pa.int32()))], names=["toxic", "copies", "held"])
                    continue
                counts: dict[str, list[int]] = {}
                for t, h in zip(toxic, held, strict=True):
                    for f in h:
                        counts.setdefault(f, [0, 0])[0 if t > 0 else 1] += 1
                yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                                       pa.array([c[1] for c in counts.values()], pa.int64())], names=["feature", "toxic", "clean"])
    return rows.mapInArrow(run, schema)


def fit_weights(doc: np.ndarray, feature: np.ndarray, y: np.ndarray, weight: np.ndarray, n: int,
                l1: float = 0.1, l2: float = 0.003, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Bias and non-negative weights of a logistic regression with both penalties (accelerated proximal gradient)."""
    def times(w):
        return np.bincount(doc, w[feature], len(y))

    def back(r):
        return np.bincount(feature, r[doc], n)
    v = np.ones(n)
    for _ in range(20):  # largest eigenvalue, for the step
        v = back(weight * times(v)) + 1e-12
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (0.25 * size + l2 + 1e-9)
    rate = float((weight * y).sum() / weight.sum())
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    bias, w, z, t = math.log(rate / (1 - rate)), np.zeros(n), np.zeros(n), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(bias + times(z))))
        new = np.maximum(0.0, z - step * (back(weight * (p - y)) + l2 * z + l1))
        t, last = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        z = new + (last - 1) / t * (new - w)
        w = new
        p = 1 / (1 + np.exp(-(bias + times(w))))  # the bias takes a Newton step of its own
        bias -= float((weight * (p - y)).sum() / max((weight * p * (1 - p)).sum(), 1e-6)) * 0.5
        bias = min(max(bias, -8.0), 8.0)
    return bias, w


def best_cut(logit: np.ndarray, y: np.ndarray) -> float:
    """The logit between two rows that separates toxic from clean best (F1)."""
    order = np.argsort(-logit, kind="stable")
    sorted_logit, right = logit[order], np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum() + 1e-12)
    ends = np.append(sorted_logit[1:] < sorted_logit[:-1], False)  # a cut between different logits
    if not ends.any():
        return float(sorted_logit[0]) + 1.0
    i = int(np.argmax(np.where(ends, f1, -1.0)))
    return float(sorted_logit[i] + sorted_logit[i + 1]) / 2


def learn_lexicon(rows: DataFrame, logp: np.ndarray, limit: int = LEXICON) -> tuple[float, dict[str, float]]:
    """Bias and feature weights, from the (bounded) labelled rows.

    Equal texts share the weight of one document. A feature is a candidate
    when three texts at least hold it and most of these are toxic.
    """
    rows = cut(rows.groupBy("text").agg(F.max("toxic").alias("toxic"), F.count("*").alias("copies")))
    found = (_document_features(rows, logp, None, "feature string, toxic long, clean long").groupBy("feature")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("toxic >= 3 and toxic > 2 * clean")
             .orderBy((F.col("toxic") - F.col("clean")).desc(), "feature").limit(limit).collect())
    number = {r["feature"]: i for i, r in enumerate(found)}
    if not number:
        return -8.0, {}
    held = _document_features(rows, logp, number, "toxic long, copies long, held array<int>").toArrow()
    y = held.column("toxic").to_numpy().astype(float)
    lists = held.column("held").combine_chunks()
    doc = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    feature = lists.values.to_numpy().astype(np.int64)
    bias, w = fit_weights(doc, feature, y, np.ones(len(y)), len(number))
    # the threshold falls where it separates the labelled rows best
    bias += math.log(THRESHOLD / (1 - THRESHOLD)) - best_cut(bias + np.bincount(doc, w[feature], len(y)), y)
    return bias, {f: float(w[i]) for f, i in number.items() if w[i] > 1e-3}


def fit(docs: DataFrame, known: DataFrame) -> tuple[np.ndarray, float, dict[str, float]]:
    """(character trigram model, bias, lexicon)."""
    logp = learn_trigrams(docs.filter(fold("doc_id", FOLDS) != HELD_OUT))
    return logp, *learn_lexicon(training_rows(docs, known), logp)


class Scorer:
    """Scores and restored lexicon words of whole texts under a fitted model."""

    def __init__(self, logp: np.ndarray, bias: float, lexicon: dict[str, float]):
        names = list(lexicon)
        number = {f: i for i, f in enumerate(names)}
        self.weight, self.bias = np.array([lexicon[f] for f in names] or [0.0]), bias

        def value(words: list[str]) -> tuple[tuple[int, ...], str]:
            hits = {number[f]: w for w in words for f in features(w) if f in number}
            return tuple(hits), " ".join(sorted(set(hits.values())))
        self.words = WordReader(logp, value, wanted=number)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, list[list[str]]]:
        doc, word, values, extra_doc, extra = self.words.texts(texts)
        hit = np.array([bool(v[0]) for v in values], bool)
        at = np.flatnonzero(hit[word]) if len(word) else np.zeros(0, np.int64)
        held: list[set[int]] = [set() for _ in range(len(texts))]
        said: list[set[str]] = [set() for _ in range(len(texts))]
        found = [*((d, values[w]) for d, w in zip(doc[at].tolist(), word[at].tolist(), strict=True)),
                 *((d, v) for d, v in zip(extra_doc, extra, strict=True) if v[0])]
        for d, (numbers, words) in found:
            held[d].update(numbers)
            said[d].add(words)
        logit = self.bias + np.array([self.weight[list(h)].sum() if h else 0.0 for h in held])
        return 1 / (1 + np.exp(-logit)), [sorted(s) for s in said]


def score(docs: DataFrame, model: tuple[np.ndarray, float, dict[str, float]]) -> DataFrame:
    """One row per document: doc_id, score, restored (lexicon words found, as restored)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = Scorer(*shared.value)
        for batch in batches:
            for part in text_parts(batch):
                scores, said = own.texts(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), pa.array(scores), pa.array(said, pa.list_(pa.string()))],
                                      names=["doc_id", "score", "restored"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, restored array<string>")


def accepted(docs: DataFrame, model: tuple[np.ndarray, float, dict[str, float]], threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = Scorer(*shared.value)
        for batch in batches:
            for part in text_parts(batch):
                scores, _ = own.texts(part.column("text"))
                yield part.filter(pa.array(scores < threshold))
    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark, sf_dir):
    """Toxicity scores of all documents, learned outside the held-out fold."""
    docs = documents(spark, sf_dir)
    scored = score(docs, fit(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "restored")
