"""Quality rules by tokeniser fertility.

Every word of a text is encoded with a public byte-fallback vocabulary. Three
measures tell how well the text suits it: characters per token, the share of
tokens that are single fallback bytes, and the entropy of the text's tokens.
What is usual depends on the language and on the length, so the bands are
learned per language (script where the language is missing) and length class
from all documents: a text is rejected when a measure lies on its bad side
(few characters per token, many fallback bytes, little entropy) further outside
the middle half of its class than a width times that half's breadth. The width
of each measure is the least at which ``GOOD_KEPT`` of the texts labelled as good
stay inside, 1 at least; without ``LEAST_CLASS`` such texts, or where they do not
differ, it is ``WIDTH``. The fallback bytes of a single character reject nothing.

Bands are learned from distinct texts that pass the base rules. A class of fewer
than ``LEAST_CLASS`` such texts uses the band of its language, then of its script,
then of all documents. Entropy depends on length, so its fallbacks are those of
the same length class of the script and of all documents.

Base rules (too few words, too many repeated words) reject on their own.

Defined cases
* null or empty text: no words, fails the base rule; measures are 0
* null language: the script of most letters stands in for it
* rows that repeat are judged alike; null ids are ordinary rows
* several labels for one id: the least quality counts; null qualities are no labels
* no rows in, no rows out; extra columns are ignored
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import cut, documents, hot_join, labels
from salesmart.llm.pieces import ChunkStore
from salesmart.llm.words import IS_SPACE, mix, ragged, span_hashes, text_bytes, text_parts, word_spans

WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
WIDTH = 3.0
GOOD_KEPT = 0.995
LEAST_CLASS = 50
MEASURES = {"chars_per_token": 0.005, "byte_share": 0.002, "entropy": 0.01}  # with the least breadth of a middle half
CHAR_BYTES = 4  # fallback bytes of one character
BAD_SIDE = {"chars_per_token": "low", "byte_share": "high", "entropy": "low"}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Vocabulary:
    """Words to piece ids, with a store of words already met."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())], bool)
        self.store = ChunkStore(self._encode)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(words, num_threads=1)
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.int32, int(counts.sum())), counts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(marks, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line."""
    n = len(offsets) - 1
    breaks = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A)]))
    starts = breaks[:-1] + ((data[breaks[:-1]] == 0x0A) if len(data) else 0)
    ends = breaks[1:]
    inside = np.append(0, np.cumsum(~IS_SPACE[data], dtype=np.int64))
    full = inside[ends] > inside[starts]
    starts, ends = starts[full], ends[full]
    doc = np.searchsorted(offsets, starts, "right") - 1
    key = span_hashes(data, starts, ends) ^ mix(doc.astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[first] = False
    return np.bincount(doc[later], minlength=n)


def repeated_words(hashes: np.ndarray, doc: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Per text: words within windows that the text holds twice or more."""
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= window:
        at = np.flatnonzero(doc[:len(doc) - window + 1] == doc[window - 1:])
        key = mix(doc[at].astype(np.uint64))
        for k in range(window):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k])
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        at = at[count[inverse] > 1]
        covered[at] += 1
        np.subtract.at(covered, at + window, 1)
    return np.bincount(doc[np.cumsum(covered)[:-1] > 0], minlength=n)


def _entropy(ids: np.ndarray, owner: np.ndarray, n: int, size: int) -> np.ndarray:
    """Bits per token of each text's own token distribution."""
    pair, count = np.unique(owner * size + ids, return_counts=True)
    of = pair // size
    total = np.bincount(of, count, n)
    return np.bincount(of, -count / total[of] * np.log2(count / total[of]), n)


def _script(text: str | None) -> str:
    """A coarse script name: of the most frequent letter block."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = codes[(codes > 0x40) & (codes < 0x20000)]
    return f"script-{int(np.bincount(letters >> 8).argmax()):x}" if len(letters) else "script-none"


def measure(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, hash of the text, class keys, base counts and the three measures."""
    def run(batches):
        own = vocabulary(path)
        for batch in batches:
            for part in text_parts(batch):
                texts = part.column("text")
                n = part.num_rows
                data, offsets = text_bytes(texts)
                inside = ~IS_SPACE[data]
                starts, ends, doc = word_spans(data, offsets)
                words = np.bincount(doc, minlength=n)
                chars = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
                slot = own.store.lookup(data, starts, ends) if len(starts) else np.zeros(0, np.int64)
                counts = own.store.counts[slot].astype(np.int64)
                ids = own.store.ids[ragged(own.store.starts[slot], counts)]
                owner = np.repeat(doc, counts)
                tokens = np.bincount(owner, minlength=n)
                some = np.maximum(tokens, 1)
                script = [_script(t.as_py()) for t in texts]
                lang = [x if x is not None else s for x, s in zip(part.column("lang").to_pylist(), script, strict=True)]
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("text_key"), pa.array(lang, pa.string()), pa.array(script, pa.string()), pa.array(np.floor(np.log2(words + 1)).astype(np.int32)),
                     pa.array(words), pa.array(chars), pa.array(_per_text(_SYMBOL[data], offsets)),
                     pa.array(repeated_lines(data, offsets)), pa.array(repeated_words(span_hashes(data, starts, ends), doc, n)),
                     pa.array(tokens), pa.array(chars / some), pa.array(np.bincount(owner[own.is_byte[ids]], minlength=n) / some),
                     pa.array(_entropy(ids, owner, n, len(own.is_byte)).astype(float))],
                    names=["doc_id", "text_key", "lang", "script", "length_class", *_FIELDS, "n_tokens", *MEASURES])
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _FIELDS)
    return docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("text_key")).mapInArrow(
        run, f"doc_id {kind}, text_key long, lang string, script string, length_class int, {counts}, n_tokens long, " + ", ".join(f"{m} double" for m in MEASURES))


def bands(rows: DataFrame, keys: list[str], least: int = LEAST_CLASS) -> DataFrame:
    """Per class of at least ``least`` texts: edge (of the middle half, on the bad side) and breadth of each measure."""
    quartiles = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.percentile_approx(m, [0.25, 0.75], 10_000).alias(m) for m in MEASURES])
    found = [F.struct(F.col(m)[0 if BAD_SIDE[m] == "low" else 1].alias("edge"), F.greatest(F.col(m)[1] - F.col(m)[0], F.lit(floor)).alias("breadth"))
             .alias(f"{m}_band") for m, floor in MEASURES.items()]
    return quartiles.filter(F.col("n") >= least).select(*keys, *found)


def class_bands(rows: DataFrame, least: int = LEAST_CLASS) -> DataFrame:
    """Per class that occurs: the band of each measure from the narrowest group of enough distinct texts that pass the base rules."""
    keys = ["lang", "script", "length_class"]
    texts = cut(rows.filter("NOT base_failed").select(*keys, "text_key", *MEASURES).distinct())
    plain = [m for m in MEASURES if m != "entropy"]  # these depend little on length
    found = rows.select(*keys).distinct()
    ladder = [(["lang", "length_class"], least, list(MEASURES)), (["lang"], least, plain), (["script", "length_class"], least, list(MEASURES)),
              (["script"], least, plain), (["length_class"], 1, ["entropy"])]
    for k, (by, n, of) in enumerate(ladder):
        # the classes are far fewer than the texts; a script or length has few of them
        found = found.join(bands(texts, by, n).select(*by, *[F.col(f"{m}_band").alias(f"{m}_{k}") for m in of]), by, "left")
    found = found.crossJoin(F.broadcast(bands(texts, [], 1).select(*[F.col(f"{m}_band").alias(f"{m}_{len(ladder)}") for m in plain])))
    return found.select(*keys, *[F.coalesce(*[f"{m}_{k}" for k in range(len(ladder) + 1) if f"{m}_{k}" in found.columns]).alias(f"{m}_band") for m in MEASURES])


def placed(rows: DataFrame, least: int = LEAST_CLASS) -> DataFrame:
    """The rows with the distance of each measure from its class's middle half, in breadths; null without a band."""
    joined = hot_join(rows, class_bands(rows, least), ["lang", "script", "length_class"], how="left")
    far = []
    for m, side in BAD_SIDE.items():
        band = F.col(f"{m}_band")
        gap = (band["edge"] - F.col(m)) if side == "low" else (F.col(m) - band["edge"])
        far.append((gap / band["breadth"]).alias(f"{m}_far"))
    return joined.select(*rows.columns, *far)


def widths(rows: DataFrame, known: DataFrame | None, least: int = LEAST_CLASS) -> dict[str, float]:
    """Per measure: the distance within which ``GOOD_KEPT`` of the distinct good texts stay."""
    found = dict.fromkeys(MEASURES, WIDTH)
    if known is None:
        return found
    good = known.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality > 0")
    texts = rows.filter("NOT base_failed").join(good.select("doc_id"), "doc_id", "left_semi").select("text_key", "lang", *[f"{m}_far" for m in MEASURES]).distinct()
    seen = texts.agg(F.count("*").alias("n"), *[F.percentile_approx(f"{m}_far", GOOD_KEPT, 10_000).alias(m) for m in MEASURES]).first()
    for m in MEASURES:
        if seen["n"] >= least and seen[m] is not None and seen[m] > 0:
            found[m] = max(1.0, seen[m])
    return found


def judge(docs: DataFrame, path: str, known: DataFrame | None = None, least: int = LEAST_CLASS) -> DataFrame:
    """One row per document: counts, measures, base_failed, band_failed, kept; ``known`` (doc_id, quality) sets the widths."""
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = placed(cut(measure(docs, path).withColumn("base_failed", base)), least)
    if known is not None:
        rows = cut(rows)
    outside = F.lit(False)
    for m, width in widths(rows, known, least).items():
        beyond = F.coalesce(F.col(f"{m}_far") > width, F.lit(False))
        if m == "byte_share":
            beyond &= F.round(F.col(m) * F.col("n_tokens")) > CHAR_BYTES
        outside = outside | beyond
    return (rows.withColumn("band_failed", outside).withColumn("kept", ~F.col("base_failed") & ~F.col("band_failed"))
            .select("doc_id", *_FIELDS, "base_failed", "kept", "band_failed", "n_tokens", *MEASURES))


def op6_token_fertility(spark, sf_dir):
    """Quality verdicts of all documents by base rules and tokeniser fertility."""
    import public_tokenizers
    return judge(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), labels(spark, sf_dir))
