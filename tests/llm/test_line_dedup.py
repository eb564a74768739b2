from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from cubeloom.llm import line_dedup as ld
from cubeloom.llm.line_dedup import LineState

SPACES = " \t\n\x0b\x0c\r"


def expected(rows, min_chars=20, min_docs=3):
    held, keep = defaultdict(set), defaultdict(lambda: None)

    def key(line):
        return line.strip(SPACES).encode().lower().decode()

    def eligible(text):
        return {key(x) for x in text.split("\n") if len(key(x)) >= min_chars}

    for r in rows:
        for k in eligible(r.text or ""):
            if r.doc_id is not None:
                held[k].add(r.doc_id)
                keep[k] = max(held[k])
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        kept = [
            x
            for x in lines
            if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and r.doc_id != keep[key(x)])
        ]
        out.append((r.doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_messy_rows(spark, messy):
    state = ld.insert(ld.empty_state(spark), messy)
    assert got(ld.drop_lines(state, messy)) == expected(messy.collect())


def test_many_shards_and_a_line_in_a_third_of_all_places(spark, monkeypatch):
    monkeypatch.setattr(ld, "SHARD_KEYS", 8)
    monkeypatch.setattr(ld, "PART_LINES", 50)
    hot = "a line that very many documents share"
    rows = [(d, "\n".join([hot, f"the {d // 4} of some long lines", f"only {d} has this long line"])) for d in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    state = ld.insert(ld.insert(ld.empty_state(spark), docs.where("doc_id < 100")), docs.where("doc_id >= 100"))
    assert {r.shards for r in state.filters.collect()} == {32}
    assert frequent(state) >= {k for k, n, _ in refs(state) if n >= 3}
    lines = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", F.col("text").cast("binary").alias("text"))
    lines = lines.mapInArrow(ld._eligible(20), ld.LINES_DDL)
    known = ld._probe_by_shard(lines, state.filters, 32)
    assert lines.count() == 2_700 and 1_800 <= known.count() < 1_900
    assert got(ld.drop_lines(state, docs)) == expected(docs.collect())
    less = ld.delete(state, docs.where("doc_id % 2 = 1"))
    some = docs.where("doc_id % 2 = 0")
    assert got(ld.drop_lines(less, some)) == expected(some.collect())


def test_empty_table(spark, empty, messy):
    state = ld.insert(ld.empty_state(spark), empty)
    assert ld.drop_lines(state, empty).collect() == []
    assert {r.n_dropped for r in ld.drop_lines(state, messy).collect()} == {0}


def refs(state):
    return {(bytes(r.key), r.refs, r.keep_doc) for r in state.refs.collect()}


def frequent(state):
    found = set()
    rows = state.filters.collect()
    filters = {r.shard: ld.CuckooFilter.from_bytes(bytes(r.cells)) for r in rows}
    for key, *_ in refs(state):
        shard = int.from_bytes(key[12:]) % rows[0].shards if rows else 0
        if shard in filters and filters[shard].contains(ld.key_hashes([key]))[0]:
            found.add(key)
    return found


def test_batches_and_deletions_are_reversible(spark, tmp_path):
    lines = [f"line number {i} is long enough" for i in range(12)]
    docs = spark.createDataFrame(
        [(d, "\n".join(lines[i] for i in range(12) if (d + i) % 3)) for d in range(12)],
        "doc_id long, text string",
    )
    whole = ld.insert(ld.empty_state(spark), docs)
    halves = ld.insert(ld.insert(ld.empty_state(spark), docs.where("doc_id < 6")), docs.where("doc_id >= 6"))
    assert refs(halves) == refs(whole)
    assert got(ld.drop_lines(halves, docs)) == got(ld.drop_lines(whole, docs)) == expected(docs.collect())
    assert frequent(halves) == frequent(whole)
    some = docs.where("doc_id % 4 <> 1")
    less = ld.delete(whole, docs.where("doc_id % 4 = 1"))
    fresh = ld.insert(ld.empty_state(spark), some)
    assert refs(less) == refs(fresh)
    assert frequent(less) == frequent(fresh)
    assert got(ld.drop_lines(less, some)) == expected(some.collect())
    again = ld.insert(less, docs.where("doc_id % 4 = 1"))
    assert refs(again) == refs(whole) and frequent(again) == frequent(whole)
    gone = ld.delete(whole, docs)
    assert refs(gone) == set() and frequent(gone) == set()
    again.save(str(tmp_path / "state"))
    assert refs(LineState.load(spark, str(tmp_path / "state"))) == refs(whole)


def test_a_document_of_several_rows_counts_once(spark):
    line, other = "a line that is long enough", "another line that is long enough"
    rows = [(1, line), (1, f"{line}\n{other}"), (2, line), (3, other), (4, other), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = ld.insert(ld.empty_state(spark), docs)
    assert got(ld.drop_lines(whole, docs)) == expected(docs.collect())
    assert sorted(r.refs for r in whole.refs.collect()) == [2, 3]
    # nor is it counted again when it comes a second time
    again = ld.insert(whole, docs.where("doc_id < 4"))
    assert refs(again) == refs(whole) and again.postings.count() == whole.postings.count()


def test_cuckoo_filter_takes_and_gives_back_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2))
    one = ld.CuckooFilter.sized_for(len(keys))
    assert one.insert(keys)
    assert one.contains(keys).all()
    others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert one.contains(others).mean() < 0.01
    one.delete(keys[:10_000])
    assert one.contains(keys[10_000:]).all()
    assert one.contains(keys[:10_000]).mean() < 0.01
    assert not ld.CuckooFilter.sized_for(10).insert(keys)  # too full is told
    assert (ld.CuckooFilter.from_bytes(one.to_bytes()).cells == one.cells).all()
