"""Language models, language identification and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from .test_duplicates import prose, slow_fingerprint, slow_overlaps
from .test_tokens import assert_packed
from tickloom.llm import language_id, lm_scoring
from tickloom.llm.language_id import features, predict_languages, recognised, train_language_model
from tickloom.llm.lm_scoring import CHUNKS, COUNTS, HASHES, LEVELS, MU, LogBloom, filled, held_out_column, score_texts

SMALL = 1 << 22


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), " "]


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


@pytest.mark.parametrize("frequent", [1 << 18, 20, 0])
def test_scores(table, odd, frequent):
    rng = random.Random(1)
    more = table([(100 + k, " ".join(rng.choice(["Tick", "tock", "the", "of", f"w{rng.randrange(300)}"]) for _ in range(80))) for k in range(60)])
    docs = odd.unionByName(more)
    rows = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    words, pairs, texts = Counter(), Counter(), 0
    for key, own in rows:
        if not held(key):
            words.update(own)
            pairs.update(zip([None, *own[:-1]], own, strict=True))
            texts += 1
    total = sum(words.values())
    below = total + 0.1 * (len(words) + 1)

    def p(w):
        return (words[w] + 0.1) / below

    def quantised(n):
        return float(COUNTS[np.searchsorted(LEVELS, n, side="right")])

    def score(own):
        history, out = [None, *own[:-1]], 0.0
        for h, w in zip(history, own, strict=True):
            before = texts if h is None else words[h]
            out += math.log10((min(quantised(pairs[h, w]), before) + MU * p(w)) / (before + MU))
        return out

    want = sorted((str(key), held(key), len(own), sum(words[w] > 0 for w in own), total, round(sum(math.log10(p(w)) for w in own), 6)) for key, own in rows)
    result = score_texts(docs, held_out_column("doc_id", 10, 0), bits=SMALL, frequent=frequent).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in result) == want
    got, exact = defaultdict(list), defaultdict(list)
    for r in result:
        got[r.doc_id].append(r.score)
    for key, own in rows:
        exact[key].append(score(own))
    assert got.keys() == exact.keys()
    for key in exact:
        assert np.allclose(sorted(got[key]), sorted(exact[key]), rtol=1e-9, atol=1e-6)


def test_scores_without_training(nothing, table):
    held_out = held_out_column("doc_id", 10, 0)
    assert score_texts(nothing, held_out, bits=SMALL).collect() == []
    (row,) = score_texts(table([(1, "a b")]), F.lit(True), bits=SMALL).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_filter_never_forgets():
    """Probes reach at least the level that was put in, and seldom more."""
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * 2 + 1)
    levels = rng.integers(1, 8, len(keys)).astype(np.uint8)
    chunk_words = SMALL // 64 // CHUNKS
    owner = lm_scoring.chunk_of(keys)
    bits = np.concatenate([filled(keys[owner == c], levels[owner == c], chunk_words) for c in range(CHUNKS)])
    found = LogBloom(bits, 8).levels(keys)
    assert (found >= levels).all() and (found == levels).mean() > 0.95
    absent = LogBloom(bits, 8).levels(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * 2)
    assert (absent == 0).mean() > (1 - (1 - math.exp(-HASHES * int(levels.sum()) / SMALL)) ** HASHES) - 0.02
    assert all(LEVELS[q - 1] <= COUNTS[q] <= LEVELS[q] for q in range(1, 20))


def test_no_level_is_left_out(table):
    """A filter that is asked to be small grows with what is put in: known pairs and words of count one keep their scores."""
    docs = table([(k, "often often often " * 20 + prose(200, k)) for k in range(40)])
    roomy, small = ({r.doc_id: r.score for r in score_texts(docs, F.lit(False), bits=b).collect()} for b in (SMALL, 1 << 14))
    assert all(abs(small[k] - roomy[k]) < 0.02 * abs(roomy[k]) for k in roomy)


GERMAN = "der die das und nicht mit für über straße größe wir haben schön"
FRENCH = "le la les des une être où déjà garçon avec nous très mais"
SPANISH = "el los las una niño está qué mañana con por para según"


def sentences(words, count, seed, size=25):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words.split()) for _ in range(rng.randrange(3, size))) for _ in range(count)]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, t, lang) for lang, words in (("de", GERMAN), ("fr", FRENCH), ("es", SPANISH)) for k, t in enumerate(sentences(words, 80, lang), ord(lang[0]) * 1000)]
    rows += [(1, None, "de"), (2, "", "fr"), (3, "12 %!", "es"), (4, "und das nicht", None), (None, "les garçon", "fr")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("x"), "label": F.lit(1), "lang_pred": F.lit("es")})


def test_language_of_held_out_rows(labelled, odd):
    held_out = held_out_column("doc_id", 4, 2)
    model = train_language_model(labelled, ~held_out)
    assert model.labels == ["de", "es", "fr"] and model.temperature > 0
    assert 0 < (model.weights != 0).mean() < 0.5
    result = {(r.doc_id, r.lang_pred): r.score for r in predict_languages(labelled, model).collect()}
    truth = {r.doc_id: r.lang for r in labelled.filter(held_out).collect() if r.doc_id and r.doc_id > 10}
    assert len(truth) > 40 and sum((k, v) in result for k, v in truth.items()) > 0.97 * len(truth)
    assert all(0 <= s <= 1 for s in result.values())
    assert all(result[k, "und"] == 0.0 for k in (1, 2, 3))
    assert predict_languages(odd, model).count() == odd.count()
    kept = recognised(labelled, model, 0.4)
    assert kept.columns == labelled.columns and {1, 2, 3}.isdisjoint({r.doc_id for r in kept.collect()})


def test_labels_are_never_read_in_prediction(labelled):
    model = train_language_model(labelled, F.lit(True))
    blind = labelled.withColumns({"lang": F.lit("zz"), "doc_id": F.lit(0)})
    assert Counter(r.lang_pred for r in predict_languages(blind, model).collect()) == Counter(r.lang_pred for r in predict_languages(labelled, model).collect())


def test_nothing_to_learn_from(nothing, labelled):
    model = train_language_model(nothing, F.lit(True))
    assert {r.lang_pred for r in predict_languages(labelled, model).collect()} == {"und"}
    assert predict_languages(nothing, model).collect() == []


def test_long_texts_are_read_whole(monkeypatch):
    """In parts, the n-grams are those of the text in one piece."""
    text = " ".join(sentences(FRENCH, 300, 1)).encode()
    whole = features(text)
    monkeypatch.setattr(language_id, "PART", 1000)
    parts = features(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def plain_ngrams(text):
    """Counts by column: runs of other characters than letters are a space; n-grams of 1 to 4 characters, hashed one by one."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {re.sub(' +', ' ', letters)} "
    out = Counter()
    for n in range(1, 5):
        for i in range(len(padded) - n + 1):
            gram = 0
            for k, c in enumerate(padded[i : i + n]):
                gram = (gram * 0x01000193 + ord(c) + k + 1) % 2**32
            out[(gram ^ gram >> 15) * 0x9E3779B1 % 2**32 >> 16] += 1
    return out


def plain_ftrl(rows, labels):
    """FTRL-proximal coordinate by coordinate, with softmax over the labels."""
    bias = language_id.FEATURES
    z, n = defaultdict(float), defaultdict(float)

    def weight(c, k):
        if abs(z[c, k]) <= language_id.L1:
            return 0.0
        return -(z[c, k] - math.copysign(language_id.L1, z[c, k])) / ((language_id.BETA + math.sqrt(n[c, k])) / language_id.ALPHA + language_id.L2)

    order = np.random.default_rng(5)
    for _ in range(language_id.EPOCHS):
        for label, x in (rows[i] for i in order.permutation(len(rows))):
            x = {**x, bias: 1.0}
            w = {(c, k): weight(c, k) for c in x for k in range(labels)}
            e = [math.exp(sum(w[c, k] * v for c, v in x.items())) for k in range(labels)]
            for (c, k), old in w.items():
                g = (e[k] / sum(e) - (k == label)) * x[c]
                z[c, k] += g - (math.sqrt(n[c, k] + g * g) - math.sqrt(n[c, k])) / language_id.ALPHA * old
                n[c, k] += g * g
    return {place: weight(*place) for place in list(z)}


def test_scores_against_a_plain_model(labelled):
    """The whole fit and every prediction from the texts again: counts, TF-IDF, FTRL, softmax with the fitted temperature."""
    texts = ["Der Tag", "12 %", "  où déjà — garçon, où!", "ß", "ÀÉÎ el\nniño" * 40]
    for text in texts:
        columns, counts = features(text.encode())
        assert dict(zip(columns.tolist(), counts.tolist(), strict=True)) == (plain_ngrams(text) if any(map(str.isalpha, text)) else {})
    rows = [r for r in labelled.collect() if r.lang]
    model = train_language_model(labelled, F.lit(True))
    df = Counter(c for r in rows if any(map(str.isalpha, r.text or "")) for c in plain_ngrams(r.text))
    assert all(math.isclose(model.idf[c], math.log((1 + len(rows)) / (1 + df[c])) + 1) for c in range(language_id.FEATURES))

    def vector(text):
        x = {c: math.log1p(n) * model.idf[c] for c, n in plain_ngrams(text).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {c: v / norm for c, v in x.items()}

    some = [(model.labels.index(r.lang), vector(r.text)) for r in rows if r.doc_id and r.doc_id > 10][::10]
    weights, bias = language_id.fit_weights([(k, np.array(list(x)), np.array(list(x.values()))) for k, x in some], 3)
    want = plain_ftrl(some, 3)
    assert all(math.isclose(w, bias[k] if c == language_id.FEATURES else weights[c, k], rel_tol=1e-4, abs_tol=1e-6) for (c, k), w in want.items())
    assert (weights != 0).sum() == sum(w != 0 for (c, _), w in want.items() if c < language_id.FEATURES)
    got = {(r.doc_id, r.lang_pred): r.score for r in predict_languages(labelled, model).collect() if r.doc_id and r.doc_id > 10}
    for r in rows:
        if r.doc_id and r.doc_id > 10:
            x = vector(r.text)
            e = [math.exp((sum(float(model.weights[c, k]) * v for c, v in x.items()) + model.bias[k]) / model.temperature) for k in range(3)]
            best = max(range(3), key=lambda k: e[k])
            assert math.isclose(got[r.doc_id, model.labels[best]], e[best] / sum(e), rel_tol=1e-5)


def test_weights_separate_and_stay_sparse():
    rows = [(k % 2, np.array([k % 2, 2, 3 + k % 50]), np.array([0.7, 0.7, 0.1])) for k in range(400)]
    weights, _ = language_id.fit_weights(rows, 2)
    assert weights[0, 0] > 0 > weights[1, 0] and weights[1, 1] > 0
    assert (weights[60:] == 0).all()


def test_the_sample_stays_as_it_was_sent(labelled, monkeypatch):
    """The driver holds four bytes a feature of the sampled rows."""
    held, fit = [], language_id.fit_weights
    monkeypatch.setattr(language_id, "fit_weights", lambda rows, *rest: held.extend(rows) or fit(rows, *rest))
    train_language_model(labelled, F.lit(True))
    assert held and all(columns.nbytes + counts.nbytes == 4 * len(columns) for _, columns, counts in held)


def test_rows_without_keys_crowd_out_no_language(table):
    docs = table([(None, t) for t in sentences(GERMAN, 4200, 1)], "de").unionByName(table(list(enumerate(sentences(SPANISH, 60, 2))), "es"))
    model = train_language_model(docs, F.lit(True))
    asked = table(list(enumerate(sentences(SPANISH, 20, 3))))
    assert sum(r.lang_pred == "es" for r in predict_languages(asked, model).collect()) >= 18


def test_pipeline_stages(spark, table, tmp_path, labelled):
    """Each stage against what it must do, on the rows that the one before it kept."""
    line = prose(60, 900)
    items = [(1, prose(40, 901)), (2, prose(30, 902))]
    docs = [(k, f"{prose(80, k)}\n{prose(40, 500 + k)}") for k in range(40)]
    docs += [(100, docs[3][1]), (101, docs[3][1] + " "), (102, docs[5][1])]  # copies
    docs += [(200, f"{prose(50, 600)}\n{line}"), (201, f"{prose(50, 601)}\n{line}"), (202, f"{line}\n{prose(50, 602)}")]
    docs += [(300, f"{prose(30, 700)} {items[0][1]} {prose(30, 701)}"), (301, None), (302, ""), (303, "1234 !!")]
    folder = str(tmp_path)
    table(docs).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    rows = {k: t for k, t in docs if t and any(map(str.isalpha, t))}
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stored(stage(spark, frame, folder), name)
        got = frame.collect()
        if name == "packing":
            break
        assert frame.columns == columns
        if name == "simhash":
            groups = defaultdict(list)
            fps = {k: slow_fingerprint(t) for k, t in rows.items()}
            for k in sorted(rows):
                near = [g for g in groups if any((fps[k] ^ fps[m]).bit_count() <= 3 for m in groups[g])]
                groups[near[0] if near else k].append(k)
            rows = {k: rows[k] for k in groups}
        elif name == "substrings":
            rows |= {201: prose(50, 601), 202: prose(50, 602)}
        elif name == "decontamination":
            rows = {k: t for k, t in rows.items() if k not in slow_overlaps(rows.items(), items)}
        assert {r.doc_id: r.text for r in got} == rows
        assert all(r.n_chars == len(r.text) for r in got)
        last = frame
    assert 300 not in rows and len(rows) == 43
    assert_packed(last, got, 2048)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, folder).collect())) == sorted(map(key, got))


def test_pipeline_of_nothing(spark, nothing, tmp_path):
    nothing.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
