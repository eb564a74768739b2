import random

import numpy as np
import pytest
import xxhash

from cubeloom.llm import simhash as sh
from cubeloom.llm import simhash_wide as wide
from cubeloom.llm.simhash_wide import keep_one, near_components, sketch, survives_ring


def plain_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, linked):
    """The smallest id reachable for each place, ids None last."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_messy_rows(messy):
    rows = messy.collect()
    fps = [plain_fingerprint(r.text, 3) for r in rows]
    want = plain_components([r.doc_id for r in rows], lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 2)
    got = sh.simhash_components(messy).collect()
    assert sorted(map(str, [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got])) == sorted(
        map(str, zip([r.doc_id for r in rows], fps, want))
    )


def test_empty_table(empty):
    assert sh.simhash_components(empty).collect() == []
    assert near_components(empty).collect() == []


@pytest.mark.parametrize("max_bits, segments", [(2, 8), (2, 4), (3, 8), (4, 8), (1, 8)])
@pytest.mark.parametrize("bucket", [128, 3])
def test_links_equal_all_pairs(spark, max_bits, segments, bucket):
    rng = random.Random(3)
    fps = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(12):
            other = base
            for _ in range(rng.randint(1, 4)):
                other ^= 1 << rng.randrange(64)
            fps.add(other)
    # a crowded neighbourhood: all of them meet in one bucket
    fps |= {0b1111 << 60 ^ (i * 0x9E3779B1 & 0xFF) for i in range(200)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = {(r.u, r.v) for r in sh.near_edges(df, max_bits, segments, bucket).collect()}
    mask = (1 << 64) - 1
    assert all(bin((u ^ v) & mask).count("1") <= max_bits or max_bits % 2 == 0 for u, v in edges)
    at = {f: i for i, f in enumerate(fps)}
    pairs = {(max(at[u], at[v]), min(at[u], at[v])) for u, v in edges}
    close = lambda i, j: bin((fps[i] ^ fps[j]) & mask).count("1") <= max_bits
    assert plain_components(fps, lambda i, j: (i, j) in pairs) == plain_components(fps, close)


def test_pigeonring_never_prunes_a_pair_within_the_budget():
    rng = np.random.default_rng(5)
    for max_bits, segments in ((2, 8), (3, 8), (20, 16), (5, 4)):
        differ = np.zeros(4_000, np.uint64)
        for i in range(len(differ)):
            for b in rng.choice(64, rng.integers(0, max_bits + 1), replace=False):
                differ[i] |= np.uint64(1) << np.uint64(b)
        assert survives_ring(differ, max_bits, segments).all()
        some = np.zeros(len(differ), bool)
        for start in range(segments):
            some |= sh.within_chain(differ, start, max_bits, segments)
        assert some.all()
        keys = sh.chain_patterns(max_bits, segments)
        width = 64 // segments
        masks = [np.uint64(sum(((1 << width) - 1) << (s * width) for s in own)) for _, own in keys]
        assert np.any([(differ & m) == 0 for m in masks], axis=0).all()
    far = np.array([(1 << 64) - 1, 0xFF], np.uint64)
    assert not survives_ring(far, 2, 8).any()


def shingles(text, size=5):
    words = text.encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def planted():
    rng = random.Random(11)
    words = ["w%d" % i for i in range(3_000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(30, 400))) for _ in range(150)]
    for base in range(40):
        for _ in range(3):
            own = texts[base].split()
            for _ in range(rng.randint(0, max(1, len(own) // 60))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    passage = rng.choices(words, k=60)
    texts += [" ".join(passage + rng.choices(words, k=200)) for _ in range(100)]  # a shared passage is no copy
    crowd = rng.choices(words, k=150)
    for i in range(150):  # more than a small bucket holds
        own = list(crowd)
        own[i] = "x%d" % i
        texts.append(" ".join(own))
    return texts + ["", " ", "one two"]


def test_near_groups_equal_all_pairs(spark):
    texts = planted()
    rng = random.Random(1)
    ids = rng.sample(range(10_000), len(texts))
    sets = [shingles(t) for t in texts]
    want = plain_components(ids, lambda i, j: jaccard(sets[i], sets[j]) >= 0.8)
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_components(df).collect()}
    assert got == dict(zip(ids, want))
    assert {r.doc_id for r in keep_one(df).collect()} == set(want)


def test_near_groups_of_messy_rows(messy):
    got = near_components(messy).collect()
    assert len(got) == messy.count()
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (7, 8, 9, 10, 11)} == {
        (7, 7), (8, 7), (9, 9), (10, 9), (11, 11),
    }


def test_near_groups_of_a_crowd_with_decoys(spark):
    # one passage puts all texts into the same large buckets; every text has more decoys, near
    # in bits and not in shingles, than a text of a large bucket has first partners
    rng = random.Random(5)
    passage = ["p%d" % i for i in range(160)]
    texts = []
    for i in range(120):
        own = passage + ["t%d_%d" % (i, k) for k in range(24)]
        changed = list(own)
        for at in (40, 80, 120):
            changed[at] = "c%d_%d" % (i, at)
        texts += [" ".join(own), " ".join(changed)]
    ids = rng.sample(range(10_000), len(texts))
    sets = [shingles(t) for t in texts]
    want = plain_components(ids, lambda i, j: jaccard(sets[i], sets[j]) >= 0.8)
    assert len(set(want)) == 120  # each text with its own near copy
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_components(df).collect()} == dict(zip(ids, want))


def test_near_groups_over_several_blocks(spark, monkeypatch):
    from cubeloom.llm import simhash_wide

    for name, value in (("BUCKET", 16), ("CELL_SHINGLES", 3_000), ("STRIP", 8), ("DENSE", 4_000)):
        monkeypatch.setattr(simhash_wide, name, value)
    texts = planted()
    sets = [shingles(t) for t in texts]
    want = plain_components(range(len(texts)), lambda i, j: jaccard(sets[i], sets[j]) >= 0.8)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_components(df).collect()}
    assert got == dict(enumerate(want))


def test_near_groups_of_repeated_blocks(spark):
    # sets near 1 in common, but a block that one of the two repeats hundreds of times
    rng = random.Random(8)
    texts = []
    for i in range(30):
        own = ["w%d" % rng.randrange(9_000) for _ in range(200)]
        block = own[50:62]
        texts += [" ".join(own), " ".join(own[:62] + block * 300 + own[62:])]
    sets = [shingles(t) for t in texts]
    want = plain_components(range(len(texts)), lambda i, j: jaccard(sets[i], sets[j]) >= 0.8)
    assert len(set(want)) == 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_components(df).collect()} == dict(enumerate(want))


def test_wide_sketch_is_of_the_set():
    once = " ".join("w%d" % i for i in range(40)).encode()
    # the same shingles, some of them again
    cycle = " ".join(["a", "b", "c", "d", "e", "f"] * 3).encode()
    more = " ".join(["a", "b", "c", "d", "e", "f"] * 50 + ["a", "b"]).encode()
    assert sketch(cycle, 5) == sketch(more, 5) != sketch(once, 5)


def test_near_groups_of_repeated_doc_ids_with_different_texts(spark):
    rng = random.Random(3)
    make = lambda: ["w%d" % rng.randrange(9_000) for _ in range(100)]
    a, z = make(), make()
    near = [*a[:-2], "other", "words"]
    rows = [(1, a), (5, z), (5, near), (6, [*z[:-1], "end"]), (None, [*a[:-1], "last"]), (None, make()), (7, make())]
    rows = [(i, " ".join(w)) for i, w in rows] + [(6, None), (3, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    got = {(r.doc_id, r.component_id) for r in near_components(df).collect()}
    assert got == {(1, 1), (5, 5), (5, 1), (6, 5), (None, 1), (None, None), (7, 7), (6, 3), (3, 3)}
    kept = sorted(((r.doc_id, r.text) for r in keep_one(df).collect()), key=str)
    assert kept == sorted([rows[0], rows[1], rows[5], rows[6], rows[8]], key=str)


@pytest.mark.parametrize("n", [300, 600])
def test_a_crowd_just_below_the_similarity_leaves_few_links(n):
    """Most pairs of a cell fall short by little: all are counted, no pair leaves the task."""
    from cubeloom.llm.simhash_wide import linked_sets

    rng = random.Random(n)
    base = list(range(150))
    sets = []
    for i in range(n):
        own = set(base)
        for k in range(rng.randint(5, 20)):
            own.discard(rng.choice(base))
            own.add(1_000 + (i * 100 + k if rng.random() < 0.9 else rng.randrange(50)))
        sets.append(np.array(sorted(own), np.int64))
    want = plain_components(list(range(n)), lambda i, j: jaccard(*(set(sets[k].tolist()) for k in (i, j))) >= 0.8)
    labels = linked_sets(sets, 0.8)
    assert labels.tolist() == want and 1 < len(set(want)) < n


def test_near_fingerprints_meet_under_chains_of_the_ring_without_a_common_band(spark):
    """Two bits apart and no least hash in common: only the pigeonring's chains bring them together."""
    nodes = spark.createDataFrame(
        [(1, 0, [11, 12], 10), (2, (1 << 40) | 1, [21, 22], 10), (3, (1 << 62) - 1, [31, 32], 10)],
        "node long, fp long, bands array<long>, size long",
    )
    cells = (
        wide.meeting_keys(nodes)
        .repartition(1, "band")
        .sortWithinPartitions("band", "start", "node")
        .mapInArrow(wide._cells(wide.MAX_BITS, 0.8), "cell long, node long")
        .distinct()
    )
    assert sorted(r.node for r in cells.collect()) == [1, 2]
