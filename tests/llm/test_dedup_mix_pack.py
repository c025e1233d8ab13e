"""SimHash, mixing and packing against brute force."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from formloom.llm import mixing, packing, simhash


def components(fps, radius=2):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(fps))]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.one_of(st.none(), st.text(max_size=60), st.text("ab É\t", max_size=80)))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(0, 3))
def test_spanning_links_connect_what_pairs_connect(seed, n, radius):
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 63, 4, dtype=np.uint64)
    values = sorted({int(base[r.integers(4)]) ^ sum(1 << b for b in set(r.integers(0, 64, r.integers(0, 5)).tolist())) for _ in range(n)})
    got = simhash.spanning_links(np.array(values, np.uint64).view(np.int64), np.array([0]), radius)
    assert len(got) < len(values)
    place = {v: i for i, v in enumerate(values)}
    edges = [(place[int(a) % 2**64], place[int(b) % 2**64]) for a, b in got]
    assert all((values[a] ^ values[b]).bit_count() <= radius for a, b in edges)
    want, parent = components(values, radius), list(range(len(values)))
    for a, b in edges:
        ra, rb = parent[a], parent[b]
        parent = [ra if p == rb else p for p in parent]
    assert len(set(parent)) == len(set(want))


def test_buckets_do_not_touch():
    values = np.array([1, 3, 7 << 40, 1, 3], np.int64)
    got = simhash.spanning_links(values, np.array([0, 3]), 2)
    assert sorted(map(tuple, got.tolist())) == [(1, 3), (1, 3)]


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_near_duplicates(spark, bucket_rows):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    text = rows[7][1]
    rows += [(900, text), (901, text + " x"), (902, None), (903, ""), (904, " \t"), (None, text), (900, text), (905, "a")]
    rows += [(1000 + i, text.replace(".", f" w{i}", 1)) for i in range(12)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    got = simhash.near_duplicates(docs, bucket_rows=bucket_rows).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = components(fps)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_one(docs, bucket_rows=bucket_rows)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(None, a), (None, b), (None, b), (None, c), (1, a), (2, b), (2, "q r s t u v"), (3, "q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for keep in (simhash.keep_one, simhash.keep_distinct):
        # the only null-id row without a copy stays; the row that repeats an id leads its own component
        assert sorted(keep(docs).collect(), key=str) == sorted(spark.createDataFrame([(1, a), (2, b), (2, "q r s t u v"), (None, c)], docs.schema).collect(), key=str)
        assert keep(docs.limit(0)).count() == 0


def test_stage_finds_copies_of_similarity_from_four_fifths(spark):
    import corpus_pipeline

    r = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in r.integers(0, 26, 7))
    texts = []
    for _ in range(60):
        own = [word() for _ in range(200)]
        edits = [own.copy() for _ in range(2)]
        for n, copy in zip((3, 12), edits):  # Jaccard of about 0.86, and of 0.55
            for at in r.choice(np.arange(5, 195, 8), n, replace=False):
                copy[at] = word()
        texts += [" ".join(x) for x in (own, *edits)]
    texts += ["x y z"] * 3 + ["", None]
    sets = [simhash.shingles(t) for t in texts]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if simhash.jaccard(sets[i], sets[j]) >= 0.8:
                parent = [parent[j] if p == parent[i] else p for p in parent]
    want = sorted({min(i for i, p in enumerate(parent) if p == q) for q in parent})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(want) == 122 and sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == want
    assert sorted(r.doc_id for r in simhash.keep_distinct(docs, bucket_rows=1).collect()) == want


def test_mix(spark):
    r = np.random.default_rng(0)
    sources = [f"s{i}" for i in range(7)] + [None]
    rows = [(int(i), " ".join(["w"] * int(r.integers(0, 60))), sources[int(r.choice(8, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.05, 0.01, 0.04]))], "x") for i in range(1500)]
    rows += [(2000, None, "s0", "x"), (2001, "", None, "x"), (2002, "w " * 5000, "s3", "x"), (None, "a b", "s1", "x"), (5, "a b", "s1", "x"), (5, "a b", "s1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken string")
    got = mixing.mix(docs, block_words=64).collect()
    assert len(got) == len(rows)
    total = sum(x.size for x in got)
    assert sum({x.source: x.target for x in got}.values()) == pytest.approx(total)
    for s in sources:
        own = [x for x in got if x.source == s]
        assert sum(x.size for x in own) == own[0].source_size
        assert abs(sum(x.taken for x in own) - own[0].target) <= 1
        assert own[0].target <= 3 * own[0].source_size and all(0 <= x.taken <= 3 * x.size for x in own)
    again = mixing.mix(docs.repartition(5), block_words=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    applied = mixing.apply_mix(docs, block_words=64)
    assert applied.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = mixing.mix(docs.where("doc_id in (2000, 2001)")).collect()
    assert [x.taken for x in nothing] == [0, 0] and all(x.target == 0 for x in nothing)


def test_schedule_is_spread_evenly(spark):
    goals = spark.createDataFrame([("sa", "a", 64000, 48000.0), ("sb", "b", 64000, 16000.0)], "skey string, source string, source_size long, target double")
    slots = mixing.schedule(goals, 64).orderBy("slot").collect()
    share = np.cumsum([x.skey == "sb" for x in slots]) / np.arange(1, len(slots) + 1)
    assert len(slots) == 1000 and np.abs(share[50:] - 0.25).max() < 0.06
    assert len({(x.skey, x.block, x["round"]) for x in slots}) == 1000


def plain_best_fit(sizes, sources, clusters, capacity, most):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [
            (b["left"], b["since"], i) for i, b in enumerate(bins)
            if b["left"] >= size and (cluster < 0 or cluster not in b["clusters"]) and (source in b["sources"] or len(b["sources"]) < most)
        ]
        i = min(fits)[2] if fits else len(bins)
        if not fits:
            bins.append({"left": capacity, "since": 0, "clusters": set(), "sources": set()})
        b = bins[i]
        b["left"] -= size
        b["since"] = len(out) + 1
        b["clusters"].add(cluster)
        b["sources"].add(source)
        out.append(i)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 5), st.integers(-1, 4)), max_size=80), st.integers(1, 3))
def test_best_fit_takes_the_tightest_compatible_bin(items, most):
    cols = list(zip(*items)) if items else [[], [], []]
    bins, offsets = packing.best_fit(list(cols[0]), list(cols[1]), list(cols[2]), 20, most)
    assert bins == plain_best_fit(*cols, 20, most)
    fill = {}
    for (size, _, _), b, o in zip(items, bins, offsets):
        assert o == fill.get(b, 0)
        fill[b] = o + size


def test_pack_whole_table(spark):
    rows = [(i, "w " * (i % 90), f"s{i % 9}", "x") for i in range(400)] + [(500, "w " * 1000, None, "x"), (501, None, "s1", "x"), (None, "", "s1", "x"), (5, "w " * 5, "s5", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, bin string")
    items = packing.items(docs)
    got = packing.pack(items, len(rows), capacity=128, max_sources=3, shard_docs=100).collect()
    words = {}
    for g in got:
        words[g.doc_id] = words.get(g.doc_id, 0) + g.n_words
    assert words[500] == 1000 and words[501] == 0 and words[None] == 0 and words[5] == 10 and words[89] == 89
    bins = {}
    for g in got:
        bins.setdefault((g.shard, g.bin), []).append(g)
    for own in bins.values():
        assert sum(g.n_words for g in own) == own[0].bin_words <= 128
        assert len({g.source for g in own}) <= 3
        clusters = [g.cluster for g in own if g.cluster is not None]
        assert len(clusters) == len(set(clusters))
        spans = sorted((g.bin_offset, g.bin_offset + g.n_words) for g in own)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert packing.pack(items.limit(0), 0).count() == 0


def test_texts_without_words_conflict_with_nothing(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([None, None, "", " ", " ", "a b", "A b"])], "doc_id long, text string, source string")
    rows = packing.items(docs)
    assert rows.where("cluster is null").count() == 5
    assert len({r.bin for r in packing.pack(rows, rows.count()).collect()}) == 2


def test_near_copies_do_not_share_a_bin(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(i, base + f" end{i % 3}", "x") for i in range(9)] + [(20, "a b c", "x"), (21, None, "x"), (22, "", "x"), (None, base, "x"), (23, "d e f g", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    items = packing.items(docs, near=True)
    of = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    got = items.collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(i), len((t or "").split())) for i, t, _ in rows)
    for a in got:
        for b in got:
            if a.cluster is not None and b.cluster is not None:
                assert (a.cluster == b.cluster) == (of[a.doc_id].component_id == of[b.doc_id].component_id)
    assert all(r.cluster is None for r in got if not r.n_words)
    bins = {}
    for p in packing.pack(items, len(rows)).collect():
        bins.setdefault((p.shard, p.bin), []).append(p.cluster)
    assert all(len(own) == len(set(own)) for own in ([c for c in b if c is not None] for b in bins.values()))
    assert packing.items(docs.limit(0), near=True).count() == 0


def test_hub_of_a_large_component(spark):
    from formloom.llm.components import connected

    links = [(0, i) for i in range(1, 900)] + [(i, i + 10000) for i in range(1, 50)] + [(20000, 20001), (20001, 20002), (5, 5), (None, 3)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 900)} | {i + 10000: 0 for i in range(1, 50)} | {20001: 20000, 20002: 20000}
    assert got == want


def test_batches_are_cut_by_rows_and_bytes():
    import pyarrow as pa

    from formloom.llm.common import slices

    texts = ["a" * n for n in (10, 500, 20, 30, 40)] + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["i", "text"])
    got = list(slices([batch, batch.slice(0, 0)], 1, rows=3, text_bytes=100))
    assert [x for b in got for x in b.column(0).to_pylist()] == list(range(7))
    assert [b.num_rows for b in got] == [1, 1, 3, 2] and all(b.num_rows <= 3 for b in got)


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from formloom.llm.common import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: default, set=lambda *a: None)
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
    assert shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[4]"))).startswith("file://")
