"""FLAC round trips, chat formatting, search recall, URL filters and the pipeline's stages."""

import datetime
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from formloom.llm import ann, chat, flac, urlfilter


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=300), st.text("ab", max_size=3000)), min_size=1, max_size=6), st.sampled_from([64, 256, 4096]))
def test_flac_round_trip(texts, block):
    payloads = [flac.payload_of(t)[1] for t in texts]
    media = flac.encode(payloads, block)
    for p, s in zip(payloads, flac.decode(media)):
        assert (s.samples.view(np.uint8) ^ 0x80).tobytes() == p and s.first == list(range(0, len(p), block))


def test_flac_extremes_and_damage():
    r = np.random.default_rng(0)
    payloads = [bytes(9024), bytes([0, 255] * 4096), r.integers(0, 256, 20032, dtype=np.uint8).tobytes(), b"a" * 4096 + bytes([255]) * 64 + b"a" * 64]
    media = flac.encode(payloads)
    assert [(s.samples.view(np.uint8) ^ 0x80).tobytes() for s in flac.decode(media)] == payloads
    for at in (len(media[2]) - 1, len(media[2]) - 300, 200):
        hurt = bytearray(media[2])
        hurt[at] ^= 4
        with pytest.raises(ValueError):
            flac.decode([bytes(hurt)])


def test_crc16_is_that_of_bits():
    def slow(data):
        crc = 0
        for b in data:
            crc ^= b << 8
            for _ in range(8):
                crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
        return crc

    data = np.random.default_rng(1).integers(0, 256, 700, dtype=np.uint8)
    got = flac.crc16(data, np.array([0, 10, 100]), np.array([10, 11, 700]))
    assert got.tolist() == [slow(data[:10].tolist()), slow(data[10:11].tolist()), slow(data[100:].tolist())]


def test_media_columns(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "é" * 5000, 5), (3, "é" * 5000, 5), (None, "x" * 64, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media int")
    streams = flac.media(docs)
    got = sorted(map(tuple, flac.digests(streams).collect()), key=str)
    want = []
    for i, t, _ in rows:
        raw = (t or "").encode()
        padded = raw + bytes(-len(raw) % 64 if raw else 64)
        want.append((i, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])))
    assert sorted((g[:5] for g in got), key=str) == sorted(want, key=str)
    blocks = flac.pcm_blocks(streams).where("doc_id = 3").orderBy("block", "first_sample").collect()
    assert [b.first_sample for b in blocks] == [0, 0, 4096, 4096, 8192, 8192]
    assert b"".join(bytes(b.pcm) for b in blocks[::2]) == (np.frombuffer("é".encode() * 5000 + bytes(48), np.uint8) ^ 0x80).tobytes()
    assert flac.digests(flac.media(docs.limit(0))).count() == 0


CHATS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 0, "system", "a\\b[\\<x"), (2, 1, "tool<x>", "\\\\[["), (2, 2, None, None),
    (2, 3, "user", ""), (None, 0, "assistant", "<s>é😀</s>"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "assistant", "z" * 200000), (4, 0, "<ROLE>", "<TEXT></ROLE>\\"),
]


def test_chat_reads_back_what_went_in(spark):
    turns = spark.createDataFrame([(*r, "x") for r in CHATS], "conv_id long, turn long, role string, text string, turns string")
    formatted = chat.format_chats(turns)
    texts = {r.conv_id: r for r in formatted.collect()}
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for c in {r[0] for r in CHATS}:
        own = sorted((r for r in CHATS if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256, g.formatted_chars) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(texts[c].formatted))
    assert texts[1].problem is None and texts[1].formatted.count("[INST]") == 1 and texts[1].formatted.count("</s>") == 1
    assert texts[2].problem == "turn 1: tool<x> after system" and texts[3].problem == "turn 0: assistant after start"
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_chat_must_end_with_an_answer(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(turns).first().problem == "ends with user"


def test_nearest(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=12).astype(float).tolist()) for i in range(1500)]
    rows += [(5000 + i, rows[0][1]) for i in range(300)]  # one vector over and over
    rows += [(9000, None), (9020, [0.0] * 12), (9040, [float("nan")] * 12), (9060, [None] + [1.0] * 11), (9080, [1.0] * 3), (None, [1.0] * 12), (20, rows[20][1])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = {}
    for g in ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), block_rows=100, search_rows=0, sample_rows=700).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    usable = {i: np.array(v) for i, v in rows if i is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)}
    asked = [i for i in usable if i % 20 == 0]
    assert set(got) == set(asked)
    ids, x = np.array(list(usable)), np.array(list(usable.values()))
    hits = 0
    for i in asked:
        own = sorted(got[i])
        assert [k for k, _, _ in own] == list(range(1, 21)) and i not in [v for _, v, _ in own]
        assert all(s == pytest.approx(usable[i] @ usable[v], abs=1e-12) for _, v, s in own)
        assert own == sorted(own, key=lambda o: (-o[2], o[1]))
        score = x @ usable[i]
        score[ids == i] = -np.inf
        hits += len({int(v) for v in ids[np.lexsort((ids, -score))[:20]]} & {v for _, v, _ in own})
    assert hits >= 0.9 * 20 * len(asked)
    few = vectors.where("vec_id < 6")
    assert ann.nearest(few, few.where("vec_id = 0")).count() == 5
    assert ann.nearest(vectors.limit(0), vectors).count() == 0


def test_repeated_ids_count_once(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 8))
    x[1] = x[0] * 2
    # id 1 is nearest, and fills a block: the same row over and over, and rows of its own
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1, x[1].tolist())] * 40 + [(1, (x[1] * (1 - i / 1000)).tolist()) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(vectors, vectors.where("vec_id = 0"), search_share=4.0, block_rows=1000).collect()
    score = x @ x[0]
    score[0] = -np.inf
    assert [g.vec_id for g in sorted(got, key=lambda g: g["rank"])] == np.argsort(-score)[:20].tolist()


def brute_nearest(ids, x, q, k=20):
    s = x @ x[ids == q][0]
    s[ids == q] = -np.inf
    return ids[np.lexsort((ids, -s))[:k]].tolist()


@pytest.mark.parametrize("path, every", [("sf0.1", 20), ("check_s", 400)])
def test_recall_on_the_table(spark, path, every):
    e = spark.read.parquet(f"/root/testdata/{path}/embeddings.parquet")
    rows = e.where("embedding is not null").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    got = {}
    for g in ann.nearest(e, e.where(f"vec_id % {every} = 0")).collect():
        got.setdefault(g.query_id, set()).add(g.vec_id)
    hits = sum(len(found & set(brute_nearest(ids, x, q))) for q, found in got.items())
    assert hits >= 0.9 * 20 * len(got)


def test_all_leaves_give_what_brute_force_gives(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(900, 16))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for g in ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), search_share=4.0, search_rows=0, block_rows=64, sample_rows=300).orderBy("query_id", "rank").collect():
        got.setdefault(g.query_id, []).append(g.vec_id)
    assert got == {q: brute_nearest(np.arange(900), x, q) for q in range(0, 900, 20)}


def test_blocks_hold_each_leaf_once():
    held = [np.array([3, 0, 9, 2, 25]), np.array([4, 4])]
    spots = ann._blocks(held, 10)
    assert [(t, leaf, n) for t, leaf, _, n in spots] == [(0, 0, 1), (0, 2, 1), (0, 3, 1), (0, 4, 3), (1, 0, 1), (1, 1, 1)]
    load = {}
    for t, leaf, first, n in spots:
        for b in range(first, first + n):
            load[b] = load.get(b, 0) + -(-int(held[t][leaf]) // n)
    assert max(load.values()) <= 12 and len({(t, b) for t, _, first, n in spots for b in range(first, first + n)}) == len(load)


def test_dated_lists(spark):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    entries = [("a", "deny", "example.com", day(10), "add"), ("a", "deny", "example.com", day(20), "remove"), ("a", "deny", "example.com", day(300), "add"), ("b", "allow", "good.example.com", day(0), "add"),
               ("c", "deny", "x.org/a/b", day(0), "add"), ("d", "deny", "x.org", day(5), "add"), ("d", "deny", "x.org", day(5), "remove"), ("e", "deny", None, day(0), "add")]
    urls = ["http://example.com/", "https://u:p@WWW.Example.com.:8080/p?q=http://x.org/a/b", "http://good.example.com", "http://x.org/a/b/c", "http://x.org/a/bc", "http://notexample.com", None, "mailto:a", "http://x.org/A/b#f"]
    times = [day(0), day(9.99), day(10), day(19.99), day(20), day(400), None]
    captures = [(i * 100 + k, u, t, "x") for i, u in enumerate(urls) for k, t in enumerate(times)] * 2
    got = urlfilter.filter_captures(
        spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp, list string"), spark.createDataFrame(entries, "list string, verdict string, pattern string, since timestamp, action string")
    )
    rows = got.collect()
    assert len(rows) == len(captures)
    for r in rows:
        u, t = r.url, r.fetched_at
        listed = u in urls[:3] and t is not None and (day(10) <= t < day(20) or t >= day(300))
        denied = ["a"] if listed else ["c"] if u in (urls[3], urls[8]) and t is not None else []
        allowed = ["b"] if u == urls[2] and t is not None else []
        verdict = "invalid" if u in (None, "mailto:a") else "drop" if denied and not allowed else "keep"
        assert (r.denied_by, r.allowed_by, r.verdict) == (",".join(denied), ",".join(allowed), verdict), r
    none = spark.createDataFrame([], "list string, verdict string, pattern string, since timestamp, action string")
    assert urlfilter.filter_captures(captures_df := spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp, list string"), none).where("verdict = 'drop'").count() == 0
    assert urlfilter.filter_captures(captures_df.limit(0), none).count() == 0


def test_patterns_in_all_their_forms(spark):
    day = datetime.datetime(2024, 1, 1)
    forms = ["x.org", "x.org/", "http://x.org", "HTTPS://u@X.org.:443/?q#f", "x.org.", "*.x.org", ".x.org", " x.org "]
    for form in forms + ["x.org/a/", "http://x.org//a", "X.ORG/A"]:
        entries = spark.createDataFrame([("l", "deny", form, day, "add")], "list string, verdict string, pattern string, since timestamp, action string")
        captures = spark.createDataFrame([(1, "http://x.org/a/b", day), (2, "http://x.org/c", day), (3, "http://y.x.org/a", day), (4, "http://zx.org/a", day)], "page_id long, url string, fetched_at timestamp")
        dropped = [r.page_id for r in urlfilter.filter_captures(captures, entries).where("verdict = 'drop'").orderBy("page_id").collect()]
        assert dropped == ([1, 2, 3] if form in forms else [1]), form
    nowhere = spark.createDataFrame([("l", "deny", p, day, "add") for p in ("", "/", "http://", "*", "/a", None)], "list string, verdict string, pattern string, since timestamp, action string")
    assert urlfilter.intervals(nowhere).count() == 0


def plain_shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_pipeline_stages(spark):
    """Each stage over what the one before kept, against its rule applied row by row or to all pairs."""
    import corpus_pipeline
    from formloom.llm import langid, mixing, toxicity

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    columns, current = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = current.collect()
        before = {r.doc_id: r for r in rows}
        again = spark.createDataFrame(rows, docs.schema)
        current = stage(spark, current, sf).cache()
        after = current.collect()
        assert current.columns == columns and all(before[r.doc_id] == r for r in after), name
        kept = [r.doc_id for r in after]
        if name == "language ID":
            languages = langid.fit(again)
            assert sorted(kept) == sorted(r.doc_id for r in rows if languages.clear(r.text, corpus_pipeline.MIN_MARGIN, whole=True))
        if name == "toxicity":
            scores = toxicity.score(again, toxicity.fit(again, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
            assert sorted(kept) == sorted(r.doc_id for r in scores if r.score < 0.3)
        if name == "SimHash near-dedup":
            sets = {i: plain_shingles(r.text) for i, r in before.items()}
            near = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
            todo, leaders = set(sets), []
            while todo:
                group, edge = set(), {min(todo)}
                while edge:
                    group |= edge
                    edge = {j for j in todo - group if any(near(i, j) for i in edge)}
                leaders.append(min(group))
                todo -= group
            assert sorted(kept) == sorted(leaders)
        if name.startswith("mixing"):
            taken = {r.doc_id: r for r in mixing.mix(again).collect()}
            assert {i: kept.count(i) for i in before} == {i: int((r.taken + r.size / 2) // max(1, r.size)) for i, r in taken.items()}
            for source in {r.source for r in taken.values()}:
                own = [r for r in taken.values() if r.source == source]
                assert abs(sum(kept.count(r.doc_id) * r.size for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1
    packed = corpus_pipeline.STAGES[-1][1](spark, current, sf).collect()
    assert sum(p.n_words for p in packed) == sum(len(r.text.split()) for r in current.collect())


def test_copies_stay_with_their_source(spark):
    from formloom.llm import mixing

    words = lambda w, n: " ".join([w] * n)
    rows = [(99, words("p", 10), "a", "x"), (99, words("p", 10), "b", "x"), (1, words("q", 40), "a", "x"), (2, words("r", 5), "b", "x"), (2, words("r", 5), "b", "x"), (3, "", "a", "x"), (None, words("s", 9), "b", "x"), (None, words("t", 9), "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = sorted((r.source, r.doc_id if r.doc_id is not None else -1, r.text) for r in mixing.apply_mix(docs, block_words=4).collect())
    want = {}
    for r in mixing.mix(docs, block_words=4).collect():
        key = (r.source, r.doc_id, r.size)
        want[key] = want.get(key, 0) + (int((r.taken + r.size / 2) // r.size) if r.size else 0)
    have = {}
    for source, i, text in got:
        key = (source, None if i == -1 else i, len(text.split()))
        have[key] = have.get(key, 0) + 1
    assert have == {k: n for k, n in want.items() if n}
    assert mixing.apply_mix(docs.limit(0)).count() == 0


# a plain encoder, bit by bit, of forms that the engine's own does not write


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, size):
        self.text += format(value & ((1 << size) - 1), f"0{size}b") if size else ""

    def data(self):
        text = self.text + "0" * (-len(self.text) % 8)
        return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))


def plain_crc(data, poly, size):
    crc = 0
    for b in data:
        crc ^= b << (size - 8)
        for _ in range(8):
            crc = (crc << 1 ^ poly if crc >> (size - 1) & 1 else crc << 1) & ((1 << size) - 1)
    return crc


def plain_frame(x, number, form, variable=False, rate=4, partitions=0, method=0, escape=False, wasted=0):
    head = bytes([0xFF, 0xF9 if variable else 0xF8, 0x70 | rate, 0x00 if number % 2 else 0x02])
    n = number
    head += bytes([n]) if n < 128 else bytes([0xC0 | n >> 6, 0x80 | n & 63]) if n < 2048 else bytes([0xE0 | n >> 12, 0x80 | n >> 6 & 63, 0x80 | n & 63])
    head += (len(x) - 1).to_bytes(2, "big") + {12: b"\x08", 13: b"\x1f\x40"}.get(rate, b"")
    head += bytes([plain_crc(head, 0x07, 8)])
    x = [v >> wasted for v in x]
    depth, bits = 8 - wasted, Bits()
    kind, order, coefs, shift = {"constant": (0, 0, [], 0), "verbatim": (1, 0, [], 0)}.get(form if isinstance(form, str) else "") or ((8 + form[1], form[1], [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][form[1]], 0) if form[0] == "fixed" else (31 + len(form[1]), len(form[1]), form[1], form[2]))
    bits.put(kind << 1 | (wasted > 0), 8)
    if wasted:
        bits.put(1, wasted)
    if kind < 2:
        for v in x if kind else x[:1]:
            bits.put(v, depth)
    else:
        for v in x[:order]:
            bits.put(v, depth)
        if kind >= 32:
            bits.put(13, 4)
            bits.put(shift, 5)
            for c in coefs:
                bits.put(c, 14)
        left = [x[i] - (sum(c * x[i - 1 - j] for j, c in enumerate(coefs)) >> shift) for i in range(order, len(x))]
        bits.put(method, 2)
        bits.put(partitions, 4)
        per = len(x) >> partitions
        for p in range(1 << partitions):
            part = left[max(0, p * per - order) : (p + 1) * per - order]
            if escape and p % 2:
                bits.put(31 if method else 15, 5 if method else 4)
                wide = max((v.bit_length() + 1 for v in part), default=0) if any(part) else 0
                bits.put(wide, 5)
                for v in part:
                    bits.put(v, wide)
                continue
            k = p % 5
            bits.put(k, 5 if method else 4)
            for v in part:
                u = v << 1 if v >= 0 else (-v << 1) - 1
                bits.put(0, u >> k)
                bits.put(1, 1)
                bits.put(u, k)
    data = head + bits.data()
    return data + plain_crc(data, 0x8005, 16).to_bytes(2, "big")


def plain_stream(frames, samples, block, md5=True, tables=()):
    sums = hashlib.md5(np.array(samples, np.int8).tobytes()).digest() if md5 else bytes(16)
    info = block.to_bytes(2, "big") * 2 + bytes(6) + (8000 << 44 | 7 << 36 | len(samples)).to_bytes(8, "big") + sums
    blocks = [(0, info), *tables]
    out = b"fLaC"
    for i, (kind, body) in enumerate(blocks):
        out += bytes([kind | (0x80 if i == len(blocks) - 1 else 0)]) + len(body).to_bytes(3, "big") + body
    return out + b"".join(frames)


def test_flac_streams_of_another_encoder():
    r = np.random.default_rng(5)
    walk = np.clip(np.cumsum(r.integers(-9, 10, 3000)), -128, 127).tolist()
    forms = [
        dict(form=("fixed", 0), partitions=3), dict(form=("fixed", 2), partitions=2, method=1, escape=True), dict(form=("fixed", 3), rate=12), dict(form=("fixed", 4), rate=13, partitions=4, escape=True),
        dict(form=("lpc", [900, -300, 200, 77, -50], 10), partitions=1), dict(form="verbatim"), dict(form=("fixed", 1)),
    ]
    parts, samples = [], []
    for i, kw in enumerate(forms):
        own = walk[i * 400 : i * 400 + 400]
        parts.append(plain_frame(own, i, **kw))
        samples += own
    even = [v & ~3 for v in walk[:400]]
    parts += [plain_frame(even, 7, ("fixed", 2), wasted=2), plain_frame([-64] * 400, 8, "constant", wasted=3), plain_frame(walk[:77], 9, ("fixed", 4))]
    samples += even + [-64] * 400 + walk[:77]
    half = [(3, b"".join(n.to_bytes(8, "big") + o.to_bytes(8, "big") + (400).to_bytes(2, "big") for n, o in ((0, 0), (800, len(parts[0]) + len(parts[1])))))]
    for tables in ((), half, [(4, b"\xff\xf8 a comment")], [(3, b"\xff" * 18)]):
        for md5 in (True, False):
            m = plain_stream(parts, samples, 400, md5, tables)
            (got,) = flac.decode([m])
            assert got.samples.tolist() == samples and got.first == [i * 400 for i in range(10)] and got.sizes == [400] * 9 + [77]
            assert flac.seek(m, 795, 810).tolist() == samples[795:1605] and flac.seek(m, 10**6, 4).tolist() == []
    for cut in (len(m) - 1, len(m) - 40):
        with pytest.raises(ValueError):
            flac.decode([m[:cut]])
    sizes, at, parts = [100, 300, 1000, 64], 0, []
    for i, n in enumerate(sizes):
        parts.append(plain_frame(walk[at : at + n], at, ("fixed", i), variable=True))
        at += n
    assert flac.decode([plain_stream(parts, walk[:at], 0, True)])[0].samples.tolist() == walk[:at]


def test_a_seek_decodes_the_frames_it_needs(monkeypatch):
    (m,) = flac.encode([bytes(range(256)) * 400], 4096)
    asked = []
    plain = flac._decode_frames
    monkeypatch.setattr(flac, "_decode_frames", lambda frames: asked.append(len(frames)) or plain(frames))
    assert flac.seek(m, 40970, 5).tolist() == [int(v) - 128 for v in range(10, 15)] and asked == [1]


def test_long_texts_take_little_more_than_themselves():
    import subprocess
    import sys

    code = (
        "import resource; from formloom.llm import flac; p = b'some text of words ' * 400000; p += bytes(-len(p) % 64)\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "m = flac.encode([p]); r = flac.Reading()\nfor _, a, x in flac.blocks(m): r.add(a, x)\n"
        "assert r.n == len(p); print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)"
    )
    assert float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 200


def test_all_columns_of_the_media_query(spark):
    text = "é mixed ünd text " * 700
    rows = [(1, None), (2, ""), (3, text), (4, text), (5, "x" * 64)]
    got = {r.doc_id: r for r in flac.digests(flac.media(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for i, t in rows:
        n, payload = flac.payload_of(t)
        (stored,) = flac.encode([payload])
        x = np.frombuffer(payload, np.uint8).astype(int) - 128
        crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
        feature = f"n={len(x)} sum={x.sum()} energy={(x * x).sum()} peak={abs(x).max()} crossings={crossings}"
        last = (len(payload) - 1) // 4096
        assert tuple(got[i]) == (i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, last + 1, last * 4096)
    assert tuple(got[3])[1:] == tuple(got[4])[1:]


def test_run_leaves_only_tables_that_its_result_reads(spark):
    import corpus_pipeline
    from formloom.llm.common import CUTS

    since = len(CUTS)
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = CUTS[since:]
    assert len(left) == 2 and "stage3" in left[0] and "items" in left[1]  # the documents of the mix, and what packing takes of them
    assert packed.count() > 0 and set(packed.columns) >= {"shard", "bin", "doc_id", "n_words"}


def test_all_stages_over_odd_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names, an empty table: each stage gives rows of its input."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    plain = spark.read.parquet(f"{sf}/documents.parquet")
    extra = ["node", "fp", "h", "n", "size", "copies", "taken", "n_words", "cluster", "shard", "bin", "score", "lang_pred", "skey", "row_hash", "toxic", "keys", "head", "text_hash", "salt", "deal", "share", "piece"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    tail = tuple("x" for _ in extra)
    first = plain.first()
    odd = [
        (None, None, None, None, None, *(None for _ in extra)), (None, None, None, None, None, *(None for _ in extra)), (900001, "", "en", None, 0, *tail), (900002, " \t\n", None, "s", 3, *tail),
        (900003, first.text * 400, first.lang, first.source, 1, *tail), (first.doc_id, first.text, first.lang, first.source, first.n_chars, *tail), (first.doc_id, first.text, first.lang, first.source, first.n_chars, *tail),
        (None, first.text, None, None, None, *tail), (900004, "a", "en", "s", 1, *tail), (900005, "42 ###", "xx", "s", 6, *tail), (900006, "\x00é😀 ퟿", "fr", "s", 4, *tail),
    ]
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source, r.n_chars, *tail) for r in plain.collect()] + odd, schema)
    for name, stage in corpus_pipeline.STAGES:
        known = {str(r) for r in docs.collect()}
        out = stage(spark, docs, sf)
        rows = out.collect()
        if name.startswith("best-fit"):
            assert sum(r.n_words for r in rows) == sum(len((r.text or "").split()) for r in docs.collect()) and len(rows) >= docs.count()
        else:
            assert out.columns == docs.columns and {str(r) for r in rows} <= known, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert len(known) > 150
