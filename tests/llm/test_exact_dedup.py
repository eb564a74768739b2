import hashlib
from collections import defaultdict

from cubeloom.llm.exact_dedup import ContentTable, exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r.text or ""].append((r.doc_id is not None, r.doc_id or 0, i))
    out = []
    for r in rows:
        own = groups[r.text or ""]
        best = max(own)
        keep = best[1] if best[0] else None
        digest = hashlib.sha256((r.text or "").encode()).hexdigest()
        out.append((r.doc_id, keep, len(own), digest))
    return sorted(out, key=str)


def test_messy_rows_and_one_kept_row_per_text(messy):
    rows = exact_dedup(messy).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)
    assert got == expected(messy.collect())
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_recursion_when_no_table_holds_two_texts(messy):
    rows = exact_dedup(messy, table_bytes=300).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)
    assert got == expected(messy.collect())


def test_empty_table(empty):
    assert exact_dedup(empty).collect() == []


def test_table_compares_contents_and_not_hashes():
    table = ContentTable(1_000)
    assert table.find_or_add(5, b"a") == 0
    assert table.find_or_add(5, b"b") == 1  # same hash, other content
    assert table.find_or_add(5 + 1024, b"c") == 2  # same slot
    assert table.find_or_add(5, b"a") == 0
    assert table.find_or_add(9, b"x" * 2_000) is None  # no room, table not empty
    assert ContentTable(1).find_or_add(9, b"x" * 2_000) == 0  # but always room for one
    for i in range(3_000):
        table.budget = 1 << 30
        table.find_or_add(i, b"%d" % i)
    assert table.find_or_add(5, b"b") == 1
