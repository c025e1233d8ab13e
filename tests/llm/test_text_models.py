"""Toxicity, language ID and language-model scores against held-out labels and brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from formloom.llm import langid, lm, toxicity
from formloom.llm.common import held_out

DOCS = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, extra string, score double"


def odd_rows(spark):
    return spark.createDataFrame([(1, None, "x", 0.5), (None, "", None, None), (3, " \n\t", "x", 1.0), (4, "42 ###", "x", 1.0), (5, "the of and " * 30000, "x", 1.0), (5, "the of and " * 30000, "x", 1.0)], ODD)


def test_held_out_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_gradients_of_the_network():
    shape = toxicity.Shape(window=6, stride=3, hidden=3, attention=2, word_rows=64, gram_rows=64, width=2)
    net = toxicity.Network(shape, 3)
    r = np.random.default_rng(0)
    for k in net.p:
        net.p[k] = r.normal(0, 0.5, net.p[k].shape).astype(np.float64)
    w = toxicity.split_words(["one two three four", "five six seven one two three four"], shape)
    _, begin, length = toxicity.window_starts(w.counts, shape)

    def loss():
        sub, used = w.only(begin, length)
        ids, mask = net.lanes(sub, begin, length)
        cache = {}
        x = net.inputs(w, used).astype(np.float64)
        projected = tuple(np.concatenate([x @ net.p["w" + k] + net.p["b" + k], np.zeros((1, 9))]) for k in "fb")
        return net.forward(projected, ids, mask, cache), cache, used, x

    logits, cache, used, x = loss()
    grads = net.backward(x, cache, np.ones(len(logits), np.float32))
    for k in ("uf", "ub", "wa", "va", "wo", "wf", "wb", "bf"):
        flat, got, want = net.p[k].reshape(-1), [], []
        for i in range(0, len(flat), max(1, len(flat) // 5)):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()[0].sum()
            flat[i] = old - 1e-3
            down = loss()[0].sum()
            flat[i] = old
            want.append((up - down) / 2e-3)
            got.append(grads[k].reshape(-1)[i])
        assert np.allclose(got, want, atol=2e-2, rtol=5e-2), k


def test_windows_cover_every_word():
    shape = toxicity.Shape(window=8, stride=5)
    text, begin, length = toxicity.window_starts(np.array([0, 1, 8, 9, 30]), shape)
    seen = np.zeros(48, int)
    for b, n in zip(begin, length):
        seen[b : b + n] += 1
        assert n <= 8
    assert (seen > 0).all() and 0 not in text


def test_toxic_word_is_found_anywhere_in_a_long_text():
    r = np.random.default_rng(1)
    plain = lambda n: " ".join(r.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"], n))
    texts, labels = [], []
    for i in range(240):
        words = plain(90).split()
        if i % 3 == 0:
            words[int(r.integers(0, 90))] = "grobnik" + "".join(r.choice(list("aeionst"), 3))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    net = toxicity.train(texts, labels, epochs=6)
    hidden = plain(3000) + " grobnikuru " + plain(3000)
    scores = net.scores([hidden, plain(6000), None, ""])
    assert scores[0] >= 0.3 > scores[1] and scores[2] == scores[3] == 0.0


def f1(found, want):
    found, want = np.array(found, bool), np.array(want, bool)
    return 2 * (found & want).sum() / max(1, found.sum() + want.sum())


def test_toxicity_beats_a_table_of_words_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = docs.join(labels, "doc_id").where("text is not null").select("doc_id", "text", "toxic", held_out(docs.doc_id).alias("held")).orderBy("doc_id").collect()
    scored = {r.doc_id: r for r in toxicity.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), toxicity.fit(docs, labels)).collect()}
    held = [r for r in rows if r.held]
    own = f1([scored[r.doc_id].predicted for r in held], [r.toxic for r in held])
    # the baseline: the largest log-odds of a document's words, cut where it is best on the rows it was made from
    words = lambda r: set(re.findall(r"\w+", r.text.lower()))
    seen, n = [Counter(), Counter()], [0, 0]
    for r in rows:
        if not r.held:
            seen[r.toxic].update(words(r))
            n[r.toxic] += 1
    odds = lambda w: math.log((seen[1][w] + 0.5) / (n[1] + 1)) - math.log((seen[0][w] + 0.5) / (n[0] + 1))
    worst = lambda r: max(map(odds, words(r)), default=-9.0)
    fitted = [(worst(r), r.toxic) for r in rows if not r.held]
    cut = max({s for s, _ in fitted}, key=lambda c: f1([s >= c for s, _ in fitted], [t for _, t in fitted]))
    table = f1([worst(r) >= cut for r in held], [r.toxic for r in held])
    caught = np.mean([scored[r.doc_id].predicted for r in held if r.toxic])
    print(f"network F1 {own:.3f}, recall {caught:.3f}; word table F1 {table:.3f}")
    assert own > table and own > 0.87 and caught > 0.85


def test_training_windows_are_bounded_and_spread():
    shape = toxicity.Shape(window=8, stride=6)
    assert toxicity.cut_windows(None, shape, 4, 100) == toxicity.cut_windows(" ", shape, 4, 100) == []
    text = " ".join(f"w{i}" for i in range(1000))
    got = toxicity.cut_windows(text, shape, 5, 1000)
    assert len(got) == 5 and got[0].startswith("w0 ") and int(got[-1].split()[0][1:]) > 700
    every = toxicity.cut_windows(text, shape, 10**6, 1000)
    assert {w for x in every for w in x.split()} == set(text.split())
    assert toxicity.cut_windows("a " * 6 + "x" * 5000, shape, 9, 1000) == []


def test_ids_with_both_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(40)] + [(0, "another text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(i, 1 - i % 2) for i in range(0, 40, 4)] + [(1, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity.sample(docs, labels, 100).collect()}
    assert got == {i: i % 2 for i in range(40) if i % 4 and zlib.crc32(str(i).encode()) % 4 != 2}


def test_toxicity_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    net = toxicity.fit(odd_rows(spark), empty)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.fit(odd_rows(spark), labels).scale == net.scale  # no labelled document: nothing to learn from
    rows = toxicity.score(odd_rows(spark), net).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score(odd_rows(spark).limit(0), net).count() == 0
    assert toxicity.keep_clean(odd_rows(spark), net).columns == ["doc_id", "text", "extra", "score"]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet")
    languages = langid.fit(docs)
    rows = langid.identify(docs, languages).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    kept = langid.keep_identified(docs, languages, 0.0005)
    assert kept.columns == docs.columns and kept.count() > 0.995 * docs.count()


def test_mixed_and_foreign_texts_are_rejected(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.where(held_out(docs.doc_id)).where("lang is not null").collect()
    r = np.random.default_rng(1)
    by = {}
    for d in held:
        if len(d.text.split()) >= 60:
            by.setdefault(d.lang, []).append(d.text.split()[:150])
    texts = [("mixed", " ".join(a[: min(len(a), len(b)) // 2] + b[: min(len(a), len(b)) // 2])) for x in by for y in by if x < y for a, b in list(zip(by[x], by[y]))[:25]]
    texts += [("foreign", " ".join("".join(chr(97 + c) for c in r.integers(0, 26, r.integers(2, 9))) for _ in range(n))) for n in (10, 30, 100, 300) for _ in range(25)]
    texts += [("clean", d.text) for d in held]
    languages = langid.fit(docs)
    share = lambda kind: np.mean([languages.clear(t, corpus_pipeline.MIN_MARGIN, whole=True) for k, t in texts if k == kind])
    assert share("mixed") < 0.05 and share("foreign") < 0.03 and share("clean") > 0.97
    assert languages.predict("a")[0] in languages.content


def test_sizes_are_those_of_plain_compression():
    import zstandard

    languages = langid.Languages({"a": b"the of and or but " * 200, "b": "der die das und oder é ".encode() * 200, "c": b"le la les et ou mais " * 200})
    for text in ("a", "A.", "a 1", "é", "the", "der die das", "the and " * 3000, "ab " * 1500, "x" * 9000):
        clean = langid.normalise(text).encode()
        parts = languages.segments(clean)
        assert b"".join(parts) == clean and max(map(len, parts)) <= 4096 + 1 and (len(parts) == 1 or len(parts) % 2 == 0)
        want = {}
        for lang, data in languages.content.items():
            own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            options = zstandard.ZstdCompressionParameters.from_level(5, source_size=4096, dict_size=max(map(len, languages.content.values())), min_match=3, search_log=3, strategy=zstandard.STRATEGY_BTLAZY2, write_checksum=0, write_content_size=0, write_dict_id=0)
            made = zstandard.ZstdCompressor(dict_data=own, compression_params=options)
            want[lang] = sum(len(made.compress(bytes(256) + b" " + p + b" ")) for p in parts)
        lang, score = languages.predict(text)
        best, second = sorted(want.values())[:2]
        assert want[lang] == best and 0 <= score <= 1 and (best == second or score == (second - best) / second)


def test_dictionaries_come_from_anywhere_in_the_texts(spark):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(6000))
    docs = spark.createDataFrame([(i, text, "aa") for i in range(30)] + [(99, "bb only", "bb"), (100, None, "cc"), (101, "", "dd"), (102, "x", None)], "doc_id long, text string, lang string")
    content = langid.fit(docs, pieces_per_lang=20, piece_chars=200).content
    assert set(content) == {"aa", "bb"} and len(content["aa"]) <= 20 * 201
    places = sorted(text.index(w) for w in content["aa"].decode().split()[1:] if len(w) == 7 and w in text)
    assert places[-1] > len(text) * 0.6  # not the beginnings only


def test_language_edges(spark):
    languages = langid.Languages({"a": b"the of and " * 50, "b": b"der die das " * 50})
    rows = {(r.doc_id, r.lang_pred) for r in langid.identify(odd_rows(spark), languages).collect()}
    assert rows == {(1, "und"), (None, "und"), (3, "und"), (4, "und"), (5, "a")}
    assert langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string")).content == {}
    assert langid.Languages({}).predict("words") == ("und", 0.0)


def brute_force(texts, order=3, alpha=0.4):
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    words = [re.findall(r"[^\x20\x09-\x0D]+", low(t)) for t in texts]
    own = [Counter(tuple(w[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w))) for w in words]
    total, size = sum(own, Counter()), sum(map(len, words))
    for w, mine in zip(words, own):
        c, rest, log = (lambda g: total[g] - mine[g]), size - len(w), 0.0
        for i in range(len(w)):
            top = min(i + 1, order)
            for n in range(top, 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if c(g) > 0:
                    log += (top - n) * math.log(alpha) + math.log(c(g) / (c(g[:-1]) if n > 1 else rest))
                    break
            else:
                log += top * math.log(alpha) - math.log(rest + 1)
        yield len(w), log


@pytest.mark.parametrize("order", [2, 3])
def test_backoff_scores_are_those_of_brute_force(spark, order):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(80).collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(1000, None), (1001, ""), (1002, rows[0].text), (1003, "Unseen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    got = {r.doc_id: r for r in lm.backoff_scores(docs, order=order, chunk_chars=20000).collect()}
    for (doc_id, _), (n, log) in zip(rows, brute_force([t for _, t in rows], order)):
        assert got[doc_id].n_words == n and got[doc_id].log_score == pytest.approx(log, abs=1e-8)
    assert got[1000].perplexity is None and got[1001].n_words == 0 and got[1001].seen_share is None
    assert got[1002].seen_share == got[rows[0][0]].seen_share == 1.0 and got[1003].seen_share is None  # a text that occurs twice
    scanned = lm.backoff_scores(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), order=order, chunk_chars=20000, hash_rounds=2, chunk_rounds=3).collect()
    whole = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    for r, (n, log) in zip(sorted(scanned, key=lambda r: r.doc_id), brute_force(whole, order)):
        assert r.n_words == n and r.log_score == pytest.approx(log, abs=1e-7)
    assert lm.backoff_scores(docs.limit(0)).count() == 0


def test_join_of_counts_by_partition(spark):
    """Many small partitions give what one gives; within one, rows whose n-gram several chunks have get the others' counts."""
    others, rows = lm.join_counts(np.array([7, -3, 7, 5, 7, -3]), np.array([1, 2, 10, 4, 100, 3]))
    assert dict(zip(rows.tolist(), others.tolist())) == {0: 110, 2: 101, 4: 11, 1: 3, 5: 2}
    assert [len(x) for x in lm.join_counts(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 4 = 0")
    whole, dealt = (sorted(lm.backoff_scores(docs, chunk_chars=20000, hash_rounds=2, chunk_rounds=3, join_rows=n).collect()) for n in (10**9, 1000))
    assert len(whole) > 9 and [tuple(r)[:2] for r in whole] == [tuple(r)[:2] for r in dealt]
    assert [r.log_score for r in whole] == pytest.approx([r.log_score for r in dealt], abs=1e-8)


def test_rows_of_n_grams_reach_python_without_a_limit_of_bytes(spark, monkeypatch):
    """Spark checks a limit of bytes at every row; texts are limited by a number of rows that suits their sizes, and the session's limits come back."""
    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")
    seen, cut = [], lm.cut
    monkeypatch.setattr(lm, "cut", lambda df, name, *more: seen.append((name, *map(spark.conf.get, keys))) or cut(df, name, *more))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lm.small_batches(spark)
    before = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(lm, "_BATCH_MOST", 100_000, raising=False)
    assert lm.backoff_scores(docs, chunk_chars=20000, hash_rounds=1, chunk_rounds=1).count() == docs.count()
    assert [s[:2] for s in seen] == [("counts", f"{2**31 - 1}b"), ("scores", f"{2**31 - 1}b")]
    rows, sizes = int(seen[0][2]), [len((r.text or "").encode()) for r in docs.collect()]  # one file, one block
    widest = lambda n: max(sum(sizes[i : i + n]) for i in range(len(sizes)))
    assert widest(rows) <= 100_000 < widest(2 * rows) and [spark.conf.get(k) for k in keys] == before
    assert [lm._widest(s, 10) for s in ([], [3, 4], [11, 1], [5, 5, 5, 5], [1] * 9000)] == [8192, 8192, 1, 2, 8]


def test_counts_that_do_not_fit_into_places_are_a_column(spark, monkeypatch):
    assert lm._bits(9000, 1 << 20, 3, 4) == (24, 21) and lm._bits(9000, 1 << 24, 3, 4) == (28, 0) and lm._bits(0, 0, 3, 4) == (3, 0)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 4 = 0")
    fits = sorted(lm.backoff_scores(docs, chunk_chars=20000).collect())
    bits = lm._bits
    monkeypatch.setattr(lm, "_bits", lambda *a: (bits(*a)[0], 0))
    assert len(fits) > 9 and fits == sorted(lm.backoff_scores(docs, chunk_chars=20000).collect())


def test_word_hashes_tell_words_apart():
    """Words that differ in one byte at any place, in case beyond A-Z or in length differ; a word's hash doesn't depend on what is around it."""
    words = sorted({"x" * i + c + "x" * (n - i - 1) for n in (1, 7, 8, 9, 16, 17, 64, 65, 200) for i in range(n) for c in "xyé\0"} | {"É", "é", "x" * 100_000})
    one = lm.Grams(pa.array([f" {w}\n" for w in words]), 3)
    assert one.counts.tolist() == [1] * len(words) and len(set(one.hashes[0].tolist())) == len(words)
    slid = lm.Grams(pa.chunked_array([pa.array(["no", None, " ".join(reversed(words))]).slice(1), pa.array(["", "A Z a z"])]), 3)
    assert slid.counts.tolist() == [0, len(words), 0, 4] and slid.hashes[0][: len(words)].tolist() == one.hashes[0].tolist()[::-1]
    assert slid.hashes[0][-4:-2].tolist() == slid.hashes[0][-2:].tolist()


def test_backoff_scores_of_odd_rows(spark):
    long = "alpha beta gamma delta " * 20000
    rows = [(None, "alpha beta gamma"), (1, "alpha beta gamma"), (1, "alpha beta gamma"), (None, None), (2, long), (3, " \t\n"), (4, "É é alpha\x0bbeta"), (5, "Alpha BETA gamma omega")]
    docs = spark.createDataFrame([(i, t, 0.5, 7) for i, t in rows], "doc_id long, text string, log_score double, chunk int").repartition(3)
    got = sorted((str(r.doc_id), r.n_words, round(r.log_score, 7)) for r in lm.backoff_scores(docs, chunk_chars=64).collect())
    assert got == sorted((str(i), n, round(log, 7)) for (i, _), (n, log) in zip(rows, brute_force([t for _, t in rows])))
    one = lm.backoff_scores(docs.where("doc_id = 2")).first()
    assert one.n_words == 80000 and one.seen == 0
