"""The Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest

from civgraph.llm import merkle

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, hash string, "
          "tree string, at int, n int, run string, parent string, folded string")
CLASH = ("x",) * 4 + (3, 4, "r", "p", "f")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(hashes):
    """The last hash and, per leaf, the (before, after) siblings of each level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for leaf, i in enumerate(at):
            low = i // 16 * 16
            paths[leaf].append((level[low:i], level[i + 1:low + 16]))
            at[leaf] = i // 16
        level = [h(*level[i:i + 16]) for i in range(0, len(level), 16)]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        doc_id, text, lang, source, n_chars = r
        now = leaf_of(*r)
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            now = leaf_of(doc_id, lower, lang, source, n_chars)
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf_of(*r), now, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: tree([m[2] for m in sorted(groups[s])]) for s in order}
    root, high = tree([low[s][0] for s in order]) if order else (None, [])
    out = []
    for i, s in enumerate(order):
        for (_, _, leaf, now, doc_id), path in zip(sorted(groups[s]), low[s][1]):
            siblings, folded = [], now
            for before, after in path + high[i]:
                siblings += before + after
                folded = h(*before, folded, *after)
            out.append((doc_id, leaf, low[s][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def got(spark, rows, parts=3):
    docs = spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in merkle.manifest_digest(docs).collect()), key=repr)


def test_manifest_equals_brute_force(spark):
    rows = [(i, f"Text {i} ÉA", "en" if i % 7 else None, f"s{i % 19}" if i % 19 else "hot", i % 11) for i in range(0, 700, 2)]
    rows += [(i, "Hot Rows", "en", "hot", None) for i in range(1, 600, 2)]
    rows += [(None, None, None, None, None), (None, "A", None, None, 1), (None, "A", None, None, 1), (4, "", "", "", 0),
             (-7, "NEGATIVE", "en", "ä", 8), (3, "Long " * 30_000, "en", "lone", 5), (10, "Same", "en", "twice", 1),
             (10, "Same", "en", "twice", 1), (10, "Other", "en", "twice", 1)]
    want = brute(rows)
    assert got(spark, rows) == want and got(spark, rows[::-1], 7) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("rows", [
    [], [(5, "A", "en", None, 1)], [(5, "A", "en", "s", 1), (6, "B", "en", "s", 1)],
    [(5, "A", "en", "s", 1), (6, "B", "en", "t", 1)], [(i, "A", "en", "s", 1) for i in range(17)],
    [(i, "A", "en", f"{i:03d}", 1) for i in range(33)]])
def test_small_manifests(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_runs_are_linked_and_of_bounded_size(spark):
    rows = spark.range(5000).selectExpr("'t' AS tree", "sha2(cast(id AS string), 256) AS hash", "id")
    built = merkle.levels(merkle.numbered(rows, "id", "hash"), ["id"])
    assert [b.count() for b in built] == [313, 20, 2, 1]
    for low, high in zip(built, built[1:]):
        up = {r.id: r for r in high.collect()}
        for r in low.collect():
            assert len(r.members) <= 16 and up[r.parent].members[r.slot].hash == r.hash
    assert [r.parent for r in built[-1].collect()] == [None]
