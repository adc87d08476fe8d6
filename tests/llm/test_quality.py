import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from salesmart.llm import fertility, lm_score, mixing, toxicity
from salesmart.llm.common import labels

from .conftest import SMALL, by_id, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- fertility ---------------------------------------------------------------

def base_rules(text):
    text = text or ""
    words, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered), failed)


def test_fertility_counts_match_brute_force(clashing, small, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (clashing, small):
        out = fertility.judge(docs, PIECES)
        assert out.count() == docs.count()
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        for i, r in by_id(out).items():
            assert base_rules(texts[i]) == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
            words = WORD.findall(texts[i] or "")
            ids = [t for w in model.encode(words) for t in w] if words else []
            assert r["n_tokens"] == len(ids)
            if ids:
                counts = np.array(list(Counter(ids).values())) / len(ids)
                assert math.isclose(r["entropy"], -(counts * np.log2(counts)).sum(), abs_tol=1e-9)
                assert math.isclose(r["byte_share"], sum(map(model.is_byte, ids)) / len(ids), abs_tol=1e-12)
    assert fertility.judge(empty, PIECES).count() == 0


def test_bands_reject_texts_unlike_their_class(spark):
    rng = random.Random(2)
    usual = ["the", "house", "water", "of", "and", "people", "with", "small", "garden", "light", "under", "morning"]
    rows = [(i, " ".join(rng.choice(usual) for _ in range(60)), "en") for i in range(200)]
    rows.append((900, " ".join("".join(chr(0x1F300 + rng.randrange(500)) for _ in range(6)) for _ in range(60)), "en"))
    out = by_id(fertility.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES))
    assert not out[900]["kept"] and out[900]["band_failed"] and not out[900]["base_failed"]
    assert all(out[i]["kept"] for i in range(200) if not out[i]["base_failed"])


USUAL = ("the house water of and people with small garden light under morning river stone window market over through summer evening letter table "
         "father mother winter school paper number between something country always because another thought without").split()


def usual_texts(rng, n):
    """Ordinary texts of one language and length class."""
    return [[rng.choice(USUAL) for _ in range(rng.randint(90, 110))] for _ in range(n)]


def bad_texts(rng):
    """Moderately bad texts, each for one measure alone."""
    split = usual_texts(rng, 1)[0]
    split[::9] = ["xqzv" + "".join(rng.choice("bcdfgkpqvxz") for _ in range(3)) for _ in split[::9]]  # more tokens, no fewer kinds
    marked = usual_texts(rng, 1)[0]
    marked[::5] = ["something" for _ in marked[::5]]  # long words make up for the tokens of the marks
    marked[1::40] = [w + chr(0x13000 + i) for i, w in enumerate(marked[1::40])]
    few = [w for w in USUAL[14:28] for _ in range(7)]
    rng.shuffle(few)
    return {"chars_per_token": split, "byte_share": marked, "entropy": few}


def test_each_measure_rejects_moderately_bad_texts(spark):
    rng = random.Random(21)
    bad = bad_texts(rng)
    rows = [(i, " ".join(w), "en") for i, w in enumerate([*usual_texts(rng, 300), *bad.values()])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    placed = by_id(fertility.placed(fertility.measure(docs, PIECES).withColumn("base_failed", F.lit(False))))
    known = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    for marks in (None, known):
        out = by_id(fertility.judge(docs, PIECES, marks))
        assert sum(out[i]["band_failed"] for i in range(300)) <= 6
        for k, m in enumerate(bad):
            assert not out[300 + k]["base_failed"] and out[300 + k]["band_failed"], m
            assert [x for x in fertility.MEASURES if placed[300 + k][f"{x}_far"] > fertility.WIDTH] == [m]


def test_rare_languages_and_bad_copies_are_judged(spark):
    rng = random.Random(22)
    good, bad = usual_texts(rng, 200), list(bad_texts(rng).values())
    rows = [(i, " ".join(w), "en") for i, w in enumerate(good)]
    rows += [(1000 + i, " ".join(w), "zz") for i, w in enumerate(bad)]  # a rare code: the band of the script
    rows += [(1100 + i, " ".join(w), "zy") for i, w in enumerate(usual_texts(rng, 3))]
    rows.append((1200, " ".join("".join(chr(0x1F300 + rng.randrange(200)) for _ in range(3)) for _ in range(100)), None))  # a rare script: of all
    rows += [(2000 + i, " ".join(bad[0]), "en") for i in range(300)]  # more bad copies than good texts
    rows += [(3000 + i, " ".join(["zqxv"] * 100), "en") for i in range(300)]  # fail the base rules
    out = by_id(fertility.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES))
    assert all(out[i]["band_failed"] for i in [1000, 1001, 1002, 1200, *range(2000, 2300)])
    assert all(out[i]["kept"] for i in range(1100, 1103)) and sum(out[i]["band_failed"] for i in range(200)) <= 4


def test_widths_follow_the_labelled_texts(spark):
    rows = [(i, i, "en", False, i / 100, 0.0, -1.0) for i in range(1000)] + [(1000 + i, -1, "en", False, 50.0, 50.0, 50.0) for i in range(500)]
    rows = spark.createDataFrame(rows, "doc_id long, text_key long, lang string, base_failed boolean, " + ", ".join(f"{m}_far double" for m in fertility.MEASURES))
    known = spark.createDataFrame([(i, 1) for i in range(1500)] + [(999, 0)], "doc_id long, quality int")
    found = fertility.widths(rows, known)
    assert math.isclose(found["chars_per_token"], 9.95, abs_tol=0.03)  # copies count once
    assert found["byte_share"] == found["entropy"] == fertility.WIDTH  # the good texts do not differ
    assert fertility.widths(rows, known.filter("doc_id < 10")) == dict.fromkeys(fertility.MEASURES, fertility.WIDTH)


# -- language model ----------------------------------------------------------

def test_base_scores_match_brute_force(clashing, small, empty):
    for docs in (clashing, small):
        texts = [(r["doc_id"], WORD.findall(lower(r["text"])) + [None]) for r in docs.collect()]
        fold = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 for i, _ in texts}
        seen = Counter(w for i, t in texts if fold[i] != 2 for w in t)
        n, v = sum(seen.values()), len(seen)
        out = lm_score.score(docs, block_bytes=20_000)
        assert out.count() == len(texts)
        got = by_id(out)
        for i, t in texts:
            if i is not None:
                r = got[i]
                assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold[i] == 2, len(t), sum(seen[w] > 0 for w in t), n)
                assert math.isclose(r["base_score"], sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
                assert r["score"] < 0 and math.isfinite(r["score"])
    assert lm_score.score(empty).count() == 0


def plain_interpolation(texts):
    """Scores by deleted interpolation over dictionaries: {id: log10 probability}."""
    fold = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 for i, _ in texts}

    def counted(folds):
        words, pairs = Counter(), Counter()
        for i, t in texts:
            if fold[i] in folds:
                words.update(t)
                pairs.update(zip(["start", *t], t))
        return words, pairs

    def shares(words, pairs, pair):
        h, w = pair
        seen = words[None if h == "start" else h]  # the first context was seen once in every text, like the end
        kind = int(math.log2(seen)) + 1 if seen else 0
        return kind, [pairs[pair] / max(seen, 1), words[w] / max(sum(words.values()), 1), 1 / (len(words) + 1)]
    words, pairs = counted({0, 1, 4, 5, 6})
    _, held = counted({3})
    known = [(shares(words, pairs, p), m) for p, m in held.items()]
    weights = {k: list(lm_score.START_WEIGHTS) for k in range(64)}
    met = {kind for (kind, _), _ in known}
    while True:
        mass = {k: [0.0] * 3 for k in met}
        for (kind, share), m in known:
            part = [a * b for a, b in zip(weights[kind], share)]
            mass[kind] = [a + m * b / sum(part) for a, b in zip(mass[kind], part)]
        new = {k: [a / sum(v) for a in v] for k, v in mass.items()}
        change = max((abs(a - b) for k, v in new.items() for a, b in zip(v, weights[k])), default=0)
        weights |= new
        if change < lm_score.TOLERANCE:
            break
    for k in range(64):
        least = [max(a, 1e-6) for a in weights[k]]
        weights[k] = [a / sum(least) for a in least]
    for k in range(2, 64):
        if k not in met and any(j < k for j in met):
            weights[k] = weights[max(j for j in met if j < k)]
    words, pairs = counted({0, 1, 3, 4, 5, 6})
    out = {}
    for i, t in texts:
        out[i] = 0.0
        for p in zip(["start", *t], t):
            kind, share = shares(words, pairs, p)
            out[i] += math.log10(sum(a * b for a, b in zip(weights[kind], share)))
    return out


def test_scores_match_plain_interpolation(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    want = plain_interpolation([(i, WORD.findall(t) + [None]) for i, t in rows])
    got = by_id(lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=500))
    assert set(got) == set(want)
    for i, score in want.items():
        assert math.isclose(got[i]["score"], score, rel_tol=1e-6), i


def test_key_ranges_follow_the_blocks(spark, monkeypatch):
    """Many ranges, most of them without keys of a block, give the same scores as few."""
    rows = [(i, f"a{i % 5} b{i % 3} c") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = {i: r["score"] for i, r in by_id(lm_score.score(docs, block_bytes=60)).items()}
    monkeypatch.setattr(lm_score, "BLOCKS_A_RANGE", 0.1)
    assert {i: r["score"] for i, r in by_id(lm_score.score(docs, block_bytes=60)).items()} == few


def test_interpolation_beats_the_base_and_normalises(spark):
    """Held-out texts of a bigram source score better than by add-one, and P(. | h) sums to about 1."""
    rng = random.Random(4)
    follow = {w: [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(3)] for w in [a + b for a in "abcdefgh" for b in "xyz"]}
    rows = []
    for i in range(400):
        w = rng.choice(list(follow))
        text = [w]
        for _ in range(40):
            w = rng.choice(follow[w])
            text.append(w)
        rows.append((i, " ".join(text)))
    out = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out")
    s, b = out.agg(F.sum("score"), F.sum("base_score")).first()
    assert s > 0.7 * b  # log probabilities: at least 30 % nearer to 0
    bits = -s / math.log10(2) / out.agg(F.sum("n_tokens")).first()[0]
    assert bits > 1.4  # no better than the source: three equally likely followers


def test_packing_round_trip():
    for a in ([], [0, 255], [256], [70_000], [1 << 40]):
        assert lm_score._unpacked(lm_score._packed(np.array(a, np.int64))).tolist() == a


# -- toxicity ----------------------------------------------------------------

def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    pos = y.sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def test_toxicity_on_held_out_labels(spark):
    rows = toxicity.op3_toxicity(spark, "/root/testdata/sf0.01").join(labels(spark, "/root/testdata/sf0.01"), "doc_id").filter("held_out").toPandas()
    assert rows.score.between(0, 1).all()
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.85
    predicted = rows[rows.predicted == 1]
    assert (predicted.toxic == 1).mean() > 0.85 and len(predicted) >= 0.5 * rows.toxic.sum()


def synthetic(spark, n=900):
    rng = random.Random(8)
    clean = [a + b + c for a in ("ba", "re", "to", "mi") for b in ("na", "lo", "su", "ti") for c in ("r", "n", "st", "l")]
    bad = ["scoundrel", "nitwit", "weasel"]
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_obfuscated_words_are_restored(spark):
    docs, known = synthetic(spark)
    model = toxicity.fit(docs, known)
    told = ["n1tw1t", "w3as3l", "s c o u n d r e l", "n.i.t.w.i.t", "weeeeeasel", "we@sel", "sc0undre1"]
    plain = ["banar relon tosul", "b4nar 100 mail8 x", "a b c", "", None]
    rows = [(i, f"banar {t} tosul", True) for i, t in enumerate(told)] + [(100 + i, t, False) for i, t in enumerate(plain)]
    out = by_id(toxicity.score(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), model))
    assert [told[i] for i in range(len(told)) if out[i]["score"] < 0.7] == []
    assert all(out[100 + i]["score"] < 0.7 for i in range(len(plain)))
    left = toxicity.accepted(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), model)
    assert sorted(r["doc_id"] for r in left.collect()) == [100 + i for i in range(len(plain))]


def test_viterbi_finds_the_best_of_all_readings():
    """Every path through the lattice of short noisy words is listed and scored."""
    rng = np.random.default_rng(3)
    size = len(toxicity.LETTERS) + 1
    logp = np.log(rng.dirichlet(np.ones(max(size, toxicity._SIZE)), (toxicity._SIZE, toxicity._SIZE)))
    reader = toxicity.Reader(logp)
    for word in ["a", "aa", "aaa", "1d1ot", "$h1t", "f*ck", "s t u p", "b.a.d", "h3ll00", "@@ss", "4 5 5", "***", "id--iot", "x", ""]:
        best = None
        for way in itertools.product(*reader.lattice(word), [((0,), 0.0)]):
            a, b, total, said = 0, 0, 0.0, []
            for symbols, cost in way:
                total += cost
                for x in symbols:
                    total += logp[a, b, x]
                    a, b = (0 if x == 0 else b), x
                    said.append(" " if x == 0 else toxicity.LETTERS[x - 1])
            if best is None or total > best[0]:
                best = (total, "".join(said).split())
        assert reader.read(word) == best[1], word


def test_doubled_letters_leet_and_wide_spacing_are_restored(spark):
    rng = random.Random(18)
    clean = [a + b + c for a in ("ba", "re", "to", "mi") for b in ("na", "lo", "su", "ti") for c in ("r", "n", "st", "l")] + ["balloon", "letter", "summer"]
    bad, rows = ["scoundrel", "idiot", "weasel", "ass"], []
    for i in range(900):
        words = [rng.choice(clean) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(900)], "doc_id long, quality int, toxic int"))
    told = ["weeasel", "idioot", "sscoundrel", "1d107", "1d10t", "a55", "a s s", "w  e  a  s  e  l", "i \t d   i o t"]
    plain = ["balloon letter summer", "10th 455 2024", "a b c", "1 2 3", "a\ns\ns", "a s\ns"]
    texts = [(i, f"banar {t} tosul") for i, t in enumerate(told)] + [(100 + i, t) for i, t in enumerate(plain)]
    out = by_id(toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model))
    assert [t for i, t in enumerate(told) if out[i]["score"] < 0.7] == []
    assert [t for i, t in enumerate(plain) if out[100 + i]["score"] >= 0.7] == []


def test_toxicity_edge_rows(spark, clashing, empty):
    known = labels(spark, SMALL)
    out = toxicity.score(clashing, toxicity.fit(clashing, known))
    assert out.count() == len(edge_rows()) and out.filter("score is null or score < 0 or score > 1").count() == 0
    none = toxicity.fit(empty, known.filter("false"))
    assert toxicity.score(empty, none).count() == 0
    assert toxicity.score(clashing, none).filter("score >= 0.7").count() == 0
    assert toxicity.accepted(clashing, none).columns == clashing.columns


# -- mixing ------------------------------------------------------------------

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > cap * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mix_meets_targets(spark, clashing, small):
    rng = random.Random(3)
    many = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 50])), "en", rng.choice(["a", "b", "b", "b", "c", None, "é", "z"]), 0) for i in range(3000)]
    for docs in (spark.createDataFrame(many, "doc_id long, text string, lang string, source string, n_chars long"), small, clashing):
        sizes, largest, source = Counter(), Counter(), {}
        for r in docs.collect():
            n = len(WORD.findall(r["text"] or ""))
            sizes[r["source"]] += n
            largest[r["source"]] = max(largest[r["source"]], n)
            source.setdefault(r["doc_id"], r["source"])
        want = brute_targets(sizes)
        rows = mixing.mix(docs).collect()
        again = mixing.mix(docs).collect()
        assert sorted(map(str, rows)) == sorted(map(str, again))
        assert len(rows) == docs.count()
        taken = Counter()
        for r in rows:
            assert r["taken"] <= 2 * r["size"]
            if r["doc_id"] is not None and r["doc_id"] != 4:
                s = source[r["doc_id"]]
                assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
                taken[s] += r["taken"]
        if docs is not clashing:  # a tie in hash draws copies together; the edge rows have some
            for s, t in want.items():
                assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6


def test_mixed_repeats_whole_rows(clashing, empty, spark):
    counted = {r["doc_id"]: r["copies"] for r in mixing.mix(clashing).collect() if r["doc_id"] not in (None, 4)}
    out = mixing.mixed(clashing)
    assert out.columns == clashing.columns
    got = Counter(r["doc_id"] for r in out.collect())
    assert all(got[i] == n for i, n in counted.items())
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "s", 0), (2, None, "en", None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_arrow_words_agree_with_plain_python():
    from salesmart.llm.words import span_hashes, text_bytes, word_spans
    texts = [r[1] for r in edge_rows()]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends, doc = word_spans(data, offsets)
    got = [(int(d), data[s:e].tobytes().decode()) for s, e, d in zip(starts, ends, doc, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    h = span_hashes(data, starts, ends)
    assert len(np.unique(h)) == len({w for _, w in got})
