"""The corpus pipeline against brute force over a whole small documents table.

Only the classifier's scores come from its operator; its held-out accuracy is
tested on its own.
"""

import hashlib
import re
import zlib

import numpy as np

import corpus_pipeline
from civgraph.llm import quality
from civgraph.llm.common import table
from civgraph.llm.queries import word_tokenizer

SF_DIR = "/root/testdata/sf0.001"


def _shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()


def _one_of_each_group(rows):
    sets = [_shingles(r.text, 5) for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    best = {}
    for r, g in zip(rows, group):
        best[g] = min(best.get(g, r), r, key=lambda x: x.doc_id)
    return list(best.values())


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _clean(rows, items):
    windows = set()
    for item in items:
        w = _words(item)
        windows |= {tuple(w[j:j + 13]) for j in range(max(1, len(w) - 12))} if w else set()
    out = []
    for r in rows:
        w, hit = _words(r.text), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit |= set(range(j, j + n))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def _mix(rows):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    size = {r: len((r.text or "").encode().split()) for r in rows}
    key = {r: int(md5(f"mix:{r.doc_id}:{md5(r.text or '')}")[:15], 16) for r in rows}
    sources = sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[r] for r in rows if r.source == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, left = {}, set(sources)
    while left:  # shares of what is left; sources above their most are set to it
        share = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > 3 * total[s]}
        target |= {s: 3 * total[s] for s in full} if full else {s: share * weight[s] for s in left}
        left = left - full if full else set()
    copies = []
    for s in sources:
        epochs = int(target[s] // total[s]) if total[s] else 0
        upto = 0
        for r in sorted((r for r in rows if r.source == s), key=key.get):
            upto += size[r]
            more = upto - size[r] / 2 <= target[s] - epochs * total[s]
            copies += [r] * (epochs + more)
    return copies


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    documents = table(spark, SF_DIR, "documents")
    good = {r.doc_id for r in quality.quality_digest(documents, table(spark, SF_DIR, "labels")).where(
        "predicted = 1").collect()}
    rows = [r for r in documents.collect() if r.doc_id in good]
    rows = _clean(_one_of_each_group(rows), [r.text for r in table(spark, SF_DIR, "benchmark").collect()])
    tokenizer, at, want = Tokenizer.from_file(word_tokenizer()), 0, []
    for r in sorted(_mix(rows), key=lambda r: r.doc_id):
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert want and sorted(map(tuple, got)) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0
