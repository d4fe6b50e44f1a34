"""Training-data operators against brute force, on rows with nulls, empty and
long texts, ties, repeated rows and clashing column names, and on empty tables."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civgraph.llm import (chat, decontaminate, jaccard, mixing, neighbours, quality, secrets, sharding, simple8b,
                          substrings)
from civgraph.llm.common import READING, shared_folder, steady_reads, stored
from civgraph.llm.queries import word_tokenizer

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, shard int, spans string, score double, v long")
_R = random.Random(3)


def _prose(n, vocabulary=400):
    return " ".join(f"w{_R.randrange(vocabulary)}" for _ in range(n))


PASSAGE = _prose(60)
ITEM = _prose(40)
BASE = _prose(120)
TEXTS = [
    None, "", "   \n", "one", "two words", _prose(30), _prose(30) + " " + PASSAGE, PASSAGE + "\n" + _prose(12),
    _prose(5) + " " + PASSAGE + " " + _prose(7), BASE, BASE, BASE + " tail", BASE.upper(), "x " * 60, ITEM,
    _prose(200) + " " + " ".join(ITEM.split()[5:25]), "Élan ÀÉ " + _prose(40), _prose(20_000, 10**6),
    'password = "Zk39fjQm2Lx8Vb71" ' + "deadbeef" * 3, "AKIA" + "Q7" * 9 + " " + "xQ3" * 4]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", f"s{i % 3}" if i % 5 else None) for i, t in enumerate(TEXTS)]
    out += [(9, BASE, "en", "s0"), (None, BASE + " tail", None, None), (None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(*r, None, 7, 1, "a", 0.1, 5) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_mixing_totals_and_empty(docs, none, rows):
    got = mixing.mix_digest(docs).collect()
    assert len(got) == len(rows) and mixing.mix_digest(none).count() == 0
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = {}
    by_id = {r.doc_id: r for r in got}
    for r in got:
        assert r.taken <= 3 * r.size
        target.setdefault(r.source_size, r.target)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert set(target) == set(sizes.values()) and by_id[17].size == 20_000
    again = mixing.mix_digest(docs.repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_sharding_is_gapless_and_near_equal(spark, docs, none, rows):
    got = sharding.shard_digest(docs, 4).collect()
    assert len(got) == len(rows) and sharding.shard_digest(none).count() == 0
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(
        F.repeat(F.lit("ab"), (F.col("id") % 40).cast("int"))).alias("text"))
    sizes = [r[1] for r in sharding.shard_digest(many).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) < 0.02 * sum(sizes) / 24 + 200


def test_byte_cuts_are_exact_and_send_one_boundary_a_cut(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUND_BITS", 5)
    text = F.when(F.col("id") % 4 == 0, "same").otherwise(F.repeat(F.col("id").cast("string"), (F.col("id") % 9).cast("int")))
    rows = spark.range(6000).select(sharding.order_key(text, F.col("id")).alias("__key"), F.length(text).cast("long").alias("__size"))
    rows = rows.withColumn("__size", F.col("__size") + 8).cache()
    data = sorted(map(tuple, rows.collect()))
    total, sent = sum(b for _, b in data), []
    collect = type(rows).collect

    def counted(df):
        out = collect(df)
        sent.append(len(out))
        return out

    monkeypatch.setattr(type(rows), "collect", counted)
    targets = [total * i // 60 for i in range(1, 60)]
    cuts = sharding.byte_cuts(rows, targets, 20)
    assert max(sent) <= len(targets)
    for t, c in zip(targets, cuts):
        assert c.bytes == sum(b for k, b in data if k < c.key) and abs(c.bytes - t) <= 60


def test_sharding_pieces_grow_with_the_data_and_the_driver_does_not(spark, monkeypatch):
    """Cuts are asked for shards only; pieces stay small, also those of a hot text."""
    asked, cuts = [], sharding.byte_cuts
    monkeypatch.setattr(sharding, "byte_cuts", lambda rows, targets, t: asked.append(len(targets)) or cuts(rows, targets, t))
    many = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(
        F.col("id").cast("string")).alias("text"))
    got = sharding.with_shards(many, 2, piece_bytes=400).collect()
    assert asked == [1]
    for s in range(2):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    key = sharding.order_key(F.col("text"), F.col("doc_id"))
    narrow = many.select(key.alias("__key"), (F.length("text") + 8).cast("long").alias("__size")).cache()
    total = narrow.agg(F.sum("__size")).first()[0]
    pieces = sharding.with_pieces(narrow, narrow, total, 400).groupBy("__piece").agg(F.sum("__size").alias("b"), F.min("__key").alias("k"))
    sizes = [r.b for r in pieces.collect()]
    assert sum(sizes) == total and len(sizes) > 100 and max(sizes) <= 2400
    order = [r["__piece"] for r in sharding.with_pieces(narrow, narrow, total, 400).orderBy("__key").collect()]
    assert order == sorted(order)


def test_simple8b_round_trip():
    rng = np.random.default_rng(5)
    for ids in ([], [0], [2**60, 2**64 - 1, 1], rng.integers(0, 50_000, 5000), np.zeros(500), rng.integers(0, 2, 400)):
        ids = np.array(ids, dtype=np.uint64)
        words, _, escapes = simple8b.pack(ids)
        assert (simple8b.unpack(words, len(ids), escapes) == ids).all()


def test_token_output(spark, docs, none, rows):
    from tokenizers import Tokenizer

    got = simple8b.token_digest(docs, f"{shared_folder(spark)}/t", word_tokenizer()).collect()
    plain = Tokenizer.from_file(word_tokenizer())
    at = 0
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    texts = {}
    for i, t, *_ in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        texts.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in texts[r.doc_id]
        at += r.n_tokens
    assert simple8b.token_digest(none, f"{shared_folder(spark)}/t", word_tokenizer()).count() == 0


def test_decontamination(spark, docs, none, rows):
    bench = spark.createDataFrame([(1, ITEM), (2, "two words"), (3, None), (None, "")], "item_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in decontaminate.contamination_digest(docs, bench).collect()}
    assert got[14, 40].n_hit == 40 and got[14, 40].contaminated
    assert got[15, 220].n_hit == 20 and got[15, 220].contaminated
    assert got[4, 2].n_hit == 2 and got[4, 2].items_sha256 == hashlib.sha256(b"2").hexdigest()
    assert got[None, 0].n_hit == 0 and not got[5, 30].contaminated
    assert decontaminate.contamination_digest(none, bench).count() == 0
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == len(rows)
    left = {r.doc_id: r.text for r in decontaminate.without_spans(docs, bench).where("doc_id = 15").collect()}
    assert len(left[15].split()) == 200


def test_repeated_spans(docs, none, rows):
    got = {(r.doc_id, r.n_words): r for r in substrings.repeat_digest(docs).collect()}
    order = sorted({(i, t) for i, t, *_ in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen = set()
    for i, t in order:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for j in range(len(w) - 19):
            g = tuple(w[j:j + 20])
            if g in seen:
                keep[j:j + 20] = [False] * 20
            seen.add(g)
        kept = b" ".join(x for x, y in zip(w, keep) if y)
        r = got[i, len(w)]
        assert (r.n_removed, r.kept_sha256) == (len(w) - sum(keep), hashlib.sha256(kept).hexdigest()), i
    assert substrings.repeat_digest(none).count() == 0


def test_ngram_join(docs, none, rows):
    got = jaccard.join_digest(docs).collect()
    sets = {}
    for n, (i, t, *_) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[n] = i, {tuple(w[j:j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    root = {n: n for n in sets}
    for a in sets:
        for b in sets:
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                old, new = root[a], root[b]
                root = {n: new if r == old else r for n, r in root.items()}
    want = []
    for n, (i, s) in sets.items():
        ids = [sets[m][0] for m in sets if root[m] == root[n] and sets[m][0] is not None]
        want.append((i, len(s), min(ids) if ids else None))
    none_last = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=none_last) == sorted(want, key=none_last)
    assert jaccard.join_digest(none).count() == 0
    kept = jaccard.one_of_each_group(docs).collect()
    assert sum((r.text or "").lower().startswith(BASE[:40].lower()) for r in kept) == 1


def test_ngram_join_of_near_copies_about_the_threshold(spark):
    """Near copies of one text, most pairs of them just above or below the
    threshold, and short texts that share one line."""
    r = random.Random(7)
    base, line = [f"w{r.randrange(300)}" for _ in range(150)], [f"c{i}" for i in range(9)]
    data = []
    for i in range(160):
        w = list(base)
        for _ in range(r.randrange(9)):
            k = r.randrange(len(w))
            w[k:k + r.randrange(2)] = [f"x{r.randrange(10**6)}"] * r.randrange(2)
        data.append((i, " ".join(w)))
    for i in range(160, 260):
        w = [f"v{r.randrange(60)}" for _ in range(r.randrange(1, 14))]
        data.append((i, " ".join(w + line)))
    sets = {i: {tuple(w[j:j + 4]) for j in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in data)}
    root = {i: i for i in sets}
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if g == high else g for i, g in root.items()}
    got = jaccard.join_digest(spark.createDataFrame(data, "doc_id long, text string").repartition(8)).collect()
    assert {x.doc_id: x.component_id for x in got} == root and 2 < len(set(root.values())) < 258


def test_ngram_join_gives_every_link(spark, docs, none, rows, monkeypatch):
    """All links of near copies against brute force, with one block and with many."""
    r = random.Random(11)
    base = [f"w{r.randrange(300)}" for _ in range(150)]
    data = [(i, t) for i, t, *_ in rows]
    for i in range(1000, 1120):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        data.append((i, " ".join(w)))
    sets = []
    for _, t in data:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j:j + 4]) for j in range(max(1, len(w) - 3))} if w else set())
    want = sorted(((i is None, i or 0), sum(
        m != k and bool(sets[k]) and 100 * len(sets[k] & s) >= 85 * len(sets[k] | s) for m, s in enumerate(sets)))
        for k, (i, _) in enumerate(data))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    for size in (jaccard.BLOCK_ROWS, 7):
        monkeypatch.setattr(jaccard, "BLOCK_ROWS", size)
        got = jaccard.link_counts(df).collect()
        assert sorted(((x.doc_id is None, x.doc_id or 0), x.n_links) for x in got) == want
    full = jaccard.all_links(df, 4, 85)[1]
    assert full.count() == full.distinct().count() > jaccard.links(df, 4, 85)[1].count()
    assert jaccard.link_counts(none).count() == 0


def test_secrets(docs, none):
    got = {r.doc_id: r for r in secrets.secret_digest(docs).collect()}
    assert (got[18].n_assign, got[18].n_hex, got[19].n_access) == (1, 1, 1)
    assert got[None].spans == "" and secrets.secret_digest(none).count() == 0


def test_random_runs_are_found(spark):
    rng = random.Random(1)
    chars = secrets.ALPHABETS["base62"]
    found = [(i, "see " + "".join(rng.choice(chars) for _ in range(44)) + " end") for i in range(30)]
    dull = [(100 + i, "path/to/some/long/file/name/with/words" + str(i)) for i in range(30)]
    got = {r.doc_id: r.spans for r in secrets.secret_digest(spark.createDataFrame(found + dull, "doc_id long, text string")).collect()}
    assert sum(got[i] == "random:4:48" for i in range(30)) >= 27
    assert sum("random" in got[100 + i] for i in range(30)) <= 3


def test_random_runs_of_one_kind_of_character_are_tested(spark):
    """Keys of letters only or of digits only meet the battery like all others."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = [(i, "".join(rng.choice(letters) for _ in range(24))) for i in range(30)]
    numbers = [(100 + i, "".join(rng.choice("0123456789") for _ in range(40))) for i in range(30)]
    dull = [(200 + i, c * 40) for i, c in enumerate("-_a7")]
    runs = spark.createDataFrame(keys + numbers + dull, "doc_id long, token string")
    got = {r.doc_id: r.alphabet for r in secrets.random_runs(runs).collect()}
    assert sum(got.get(i) == "base62" for i in range(30)) >= 27
    assert sum(got.get(100 + i) == "digits" for i in range(30)) >= 27
    assert not any(200 + i in got for i in range(4))
    texts = spark.createDataFrame([(i, f"see {t} end") for i, t in keys + numbers], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.secret_digest(texts).collect()}
    assert sum(spans[i] == "random:4:28" for i in range(30)) >= 27
    # 16 digits or more are a base span already
    assert all(spans[100 + i] == "hex:4:44" for i in range(30))


def test_nearest(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((600, 16))
    v[10] = v[11]
    data = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000, None), (1001, [0.0] * 16), (1002, [None] * 16),
                                                       (1003, [float("nan")] * 16), (None, v[3].tolist()), (7, v[7].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, lambda i: i % 50 == 0).collect()
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 600, 50):
        score = unit @ unit[q]
        score[q] = -9
        best = np.lexsort((np.arange(600), -score))[:5]
        mine = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        assert len(mine) == 5
        hit += len(set(best.tolist()) & set(mine))
    assert hit >= 0.9 * 60
    assert neighbours.nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_nearest_gives_an_id_once_across_cells(spark):
    """Table of several cells; every id has two vectors, which often lie in different ones."""
    rng = np.random.default_rng(8)
    v = rng.standard_normal((6000, 4))
    other = v + 0.05 * rng.standard_normal(v.shape)
    data = [(i, x.tolist()) for half in (v, other) for i, x in enumerate(half)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, lambda i: i % 20 == 0).collect()
    mine = {}
    for r in got:
        mine.setdefault(r.query_id, []).append(r.vec_id)
    assert len(mine) == 300 and all(len(m) == len(set(m)) == 5 for m in mine.values())


def test_nearest_answers_vectors_of_each_length(spark):
    """Two lengths, the longer one rarer; one table large enough for several cells of the shorter."""
    rng = np.random.default_rng(9)
    short, long = rng.standard_normal((9000, 6)), rng.standard_normal((300, 11))
    data = [(i, x.tolist()) for i, x in enumerate(short)] + [(10_000 + i, x.tolist()) for i, x in enumerate(long)]
    rng.shuffle(data := np.array(data, dtype=object))
    df = spark.createDataFrame([(int(i), x) for i, x in data], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.nearest(df, lambda i: i % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == {*range(0, 9000, 50), *range(10_000, 10_300, 50)}
    hit = 0
    for q, found in got.items():
        first, v = (0, short) if q < 10_000 else (10_000, long)
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        score = unit @ unit[q - first]
        score[q - first] = -9
        best = {first + int(i) for i in np.lexsort((np.arange(len(v)), -score))[:5]}
        assert len(found) == 5 and all((i >= 10_000) == (q >= 10_000) for _, i in found)
        hit += len(best & {i for _, i in found})
    assert hit >= 0.9 * 5 * len(got)


def test_chat_tree(spark):
    text = "</s>[INST] ok [/INST]"
    turns = [(c, t, r, x) for c in range(4) for t, r, x in ((0, "system", "be\\ <|end|>\n"), (1, "user", f"hi {c % 2}"),
                                                            (2, "assistant", text if c else None))]
    turns += [(9, 0, None, None), (9, None, "assistant", "é"), (9, None, "assistant", "é")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    path = f"{shared_folder(spark)}/chat"
    got = {r.conv_id: r for r in chat.chat_digest(chat.with_probe(df), path).collect()}
    for c in (-1, 0, 1, 9):
        mine = [("user", text), ("assistant", text)] if c < 0 else [
            (r or "", x or "") for _, _, r, x in sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1] or 0))]
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in mine).encode()).hexdigest()
        learnt = "".join(x for r, x in mine if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    nodes = {r.node: r for r in spark.read.parquet(f"{path}/nodes").collect()}
    assert sum(r.depth == 0 and "system" in r.segment for r in nodes.values()) == 1  # the shared turn, once
    for r in nodes.values():  # attention covers the ancestors and nothing else
        up, want = nodes.get(r.parent), set()
        while up is not None:
            want |= set(range(up.offset, up.offset + len(up.segment)))
            up = nodes.get(up.parent)
        assert {i for a in r.attend for i in range(a["from"], a["to"])} == want and r.position == len(want)


def test_chat_tree_in_tokens(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(word_tokenizer())
    turns = [(c, t, r, x) for c in range(6) for t, r, x in (
        (0, "system", "be brief <|end|>"), (1, "user", f"hello there {c % 2}"), (2, "assistant", f"well then {c % 3}"),
        (3, "user", "" if c else "|>\n"))]
    path = f"{shared_folder(spark)}/chat"
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    chat.chat_digest(df, path, word_tokenizer()).collect()
    nodes = {r.node: r for r in spark.read.parquet(f"{path}/nodes").collect()}
    at = 0
    for r in sorted(nodes.values(), key=lambda r: r.offset):
        head = r.segment.index("|>\n", 2) + 3
        parts = [plain.encode(x, add_special_tokens=False).ids for x in (r.segment[:head], r.segment[head:-len(chat.END)], chat.END)]
        assert r.token_offset == at and r.token_ids == sum(parts, [])
        at += len(r.token_ids)
        if r.loss_from is not None:
            assert r.token_ids[r.token_loss_from:r.token_loss_to] == parts[1]
        up, want = nodes.get(r.parent), set()
        while up is not None:
            want |= set(range(up.token_offset, up.token_offset + len(up.token_ids)))
            up = nodes.get(up.parent)
        got = [i for a in r.token_attend for i in range(a["from"], a["to"])]
        assert set(got) == want and len(got) == len(want) == r.token_position


def test_quality_shape_is_that_of_the_whole_word():
    words = ["aB" * 25 + end for end in ("", "9", "-", "9-9")]
    assert len({quality._term_ids(w)[1] for w in words}) == len(words)
    assert quality._term_ids("Word12")[1] == quality._term_ids("Xy7")[1]


def test_quality_votes(spark, docs, none):
    good = [(i, _prose(60)) for i in range(300)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in _prose(40).split())) for i in range(300)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    got = quality.quality_digest(df, labels).collect()
    held = [r for r in got if r.held_out]
    assert held and sum((r.predicted == 1) == (r.doc_id < 1000) for r in held) >= 0.97 * len(held)
    mixed = quality.quality_digest(docs, labels.limit(0)).collect()
    assert all(r.score == 0.5 for r in mixed) and quality.quality_digest(none, labels).count() == 0


def test_quality_scores_equal_plain_votes(spark, docs):
    """Scores against a vote that sorts all labelled rows for each document."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 20)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    count = quality.TermCounter()
    for text, got in docs.join(quality.score(docs, model).withColumnRenamed("score", "got"), "doc_id").select("text", "got").collect():
        ids, counts = count(text)
        v = quality._weighted(ids, counts, model.idf) @ model.projection[ids].astype(float)
        norm = np.sqrt(v @ v)
        votes = []
        for k in range(len(model.labels)):
            sim = float(min(1.0, max(0.0, v @ model.vectors[k] / norm if norm > 0 else 0.0)))
            votes.append((sim, sim ** quality.SHARPNESS * model.weights[k], model.labels[k]))
        best = sorted(votes, key=lambda x: -x[0])[:quality.NEIGHBOURS]
        total = sum(w for _, w, _ in best)
        want = sum(w * y for _, w, y in best) / total if total > 1e-12 else model.prior
        assert got == pytest.approx(want, abs=2e-4)


def test_good_documents_keep_whole_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    kept = quality.good_documents(docs, labels)
    assert kept.schema == docs.schema
    score = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))).collect()}
    named = docs.where("doc_id IS NOT NULL")
    want = sorted((tuple(r) for r in named.collect() if score[r.doc_id] >= 0.5), key=repr)
    got = sorted((tuple(r) for r in kept.where("doc_id IS NOT NULL").collect()), key=repr)
    assert got == want and 0 < len(want) < named.count()


def test_quality_needs_no_package_on_the_executors(tmp_path):
    """The package is on the driver's path only: workers start elsewhere."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from civgraph.session import build_session\nfrom civgraph.llm import queries\n"
            "spark = build_session(master='local[2]', shuffle_partitions=2)\n"
            "for f in (queries.op3_quality_votes, queries.op11_impact_topk, queries.op12_grammar_runs):\n"
            "    print('rows', f(spark, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["rows", "200", "rows", "50", "rows", "200"], done.stderr[-2000:]


def repeated_rows(spark, n=1000):
    """n rows equal in id and text, n with null ids, among others."""
    rows = [(7, "one two three", "en", "s0", i % 2, "size", "items") for i in range(n)]
    rows += [(None, "four five", "en", "s1", 3, "size", "items")] * n
    rows += [(i, "word " * (i % 9), "fr", f"s{i % 3}", i, f"size {i}", f"items {i}") for i in range(10_000, 10_600)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, items string")


def test_mix_cuts_between_repeated_rows(spark):
    docs = repeated_rows(spark).repartition(5)
    got = mixing.mix_digest(docs).collect()
    assert len(got) == docs.count()
    taken, target = {}, {}
    for r in got:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[s] - target[s]) <= 9 for s in taken) and len(taken) == 3
    again = mixing.mix_digest(docs.repartition(11)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    assert len({r.taken for r in got if r.doc_id == 7}) == 2


def test_shards_spread_repeated_rows(spark):
    docs = repeated_rows(spark).repartition(5)
    for rows in (docs, docs.select("doc_id", "text")):
        got = sharding.with_shards(rows, 4)
        assert got.columns == [*rows.columns, "shard", "slot"] and got.count() == rows.count()
        sizes = [r[0] for r in got.groupBy("shard").agg(F.sum(F.octet_length("text") + 8)).select("sum((octet_length(text) + 8))").collect()]
        assert len(sizes) == 4 and max(sizes) - min(sizes) < 0.03 * sum(sizes) / 4 + 100
        for s in range(4):
            slots = sorted(r.slot for r in got.where(f"shard = {s}").collect())
            assert slots == list(range(len(slots)))


def test_stages_keep_the_values_of_clashing_columns(spark):
    docs = repeated_rows(spark, 20).withColumn("n_words", F.lit(-5)).withColumn("Spans", F.col("lang")).withColumn(
        "copies", F.col("doc_id")).withColumn("target", F.lit("t")).withColumn("epochs", F.lit("e"))
    bench = spark.createDataFrame([(1, "word " * 8)], "item_id long, text string")
    plain = {repr(tuple(r)) for r in docs.collect()}
    for out in (mixing.mixed_documents(docs), decontaminate.clean_documents(docs, bench)):
        assert out.schema == docs.schema and out.count() > 0
        assert {repr(tuple(r)) for r in out.collect()} <= plain
    left = decontaminate.without_spans(docs, bench)
    assert left.schema == docs.schema and left.drop("text").exceptAll(docs.drop("text")).count() == 0 and left.count() == docs.count()
    assert decontaminate.clean_documents(docs, bench).count() < docs.count()


def test_decontamination_of_very_long_texts(spark, monkeypatch):
    """100,000 words; by broadcast and by shuffle; an item without an id."""
    w = [f"v{_R.randrange(10**6)}" for _ in range(100_000)]
    items = [(None, " ".join(w[500:520])), (3, " ".join(w[99_980:])), (4, "v1 v2 v3 nowhere"), (5, " ".join(w[40_000:40_004]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(w[505:530])), (None, None)], "doc_id long, text string")
    for most in (500_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
        got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
        assert [(s["from"], s["to"]) for s in got[1].spans] == [(500, 520), (40_000, 40_004), (99_980, 100_000)]
        assert (got[1].n_words, got[1].n_hit, got[1].items, got[1].contaminated) == (100_000, 44, ["3", "5"], False)
        assert (got[2].n_hit, got[2].items, got[2].contaminated) == (15, [], True) and got[None].n_words == 0


def test_decontamination_marks_stay_out_of_the_plan(spark, monkeypatch):
    """Their value is no literal, whose text the driver would hold for every plan."""
    words_ = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words_)), (2, "nothing of it"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("a", " ".join(words_[10:40])), ("b", "w3 w4")], "item_id string, text string")
    plans, write = [], decontaminate.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().toString())
        return write(df, name)

    monkeypatch.setattr(decontaminate, "stored", stored)
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.contamination_digest(docs, bench).collect()}
    assert got == {1: (60, 32), 2: (3, 0), 3: (0, 0)}
    assert len(plans) > 2 and max(map(len, plans)) < 200_000


def test_decontamination_marks_are_the_ends_of_the_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MARK_SLOTS", 64)
    bench = spark.createDataFrame([(str(i), f"first{i} last{i}") for i in range(300)], "item_id string, text string")
    windows = decontaminate.item_windows(bench).cache()
    slots, marked = decontaminate.marks(windows, windows.count())
    ends = decontaminate.ends_hash(F.xxhash64(F.get("window", F.lit(0))), F.xxhash64(F.get("window", F.lit(1))))
    want = {r[0] for r in windows.select(ends.bitwiseAND(F.lit(slots - 1))).collect()}
    assert 200 < len(want) < slots and any(slot % 64 == 63 for slot in want)
    found = spark.range(slots).withColumn("m", marked).where(decontaminate.is_marked(F.col("m"), F.col("id")))
    assert {r.id for r in found.collect()} == want



def test_minimizers_are_those_of_a_plain_search(monkeypatch):
    rng = np.random.default_rng(4)
    for n in (5, 19, 20, 21, 300):
        words = rng.integers(0, 12, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        grams, got = substrings._minimizers(words)
        upper = [int(g) >> 24 for g in grams]
        width = substrings.K - substrings.M + 1
        want = [min(range(i, i + width), key=lambda p: (upper[p], p)) for i in range(max(0, n - substrings.K + 1))]
        assert got.tolist() == want and (np.diff(got) >= 0).all()
        with monkeypatch.context() as m:  # the way of texts with more m-mers than positions can be told
            m.setattr(substrings, "POSITION_BITS", 2)
            upper = [int(g) >> 2 for g in grams]
            want = [min(range(i, i + width), key=lambda p: (upper[p], p)) for i in range(max(0, n - substrings.K + 1))]
            assert substrings._minimizers(words)[1].tolist() == want or n < 24


def test_one_of_rows_equal_in_id_and_text_is_always_the_same(spark):
    rows = [(1, BASE, "en", f"s{i}", i, None) for i in range(20)] + [(2, BASE, "en", "a", 1, "x"), (3, _prose(40), None, None, None, None),
                                                                    (None, None, "en", "s", 1, None), (4, "", "en", "s", 1, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
    out = [sorted(map(tuple, jaccard.one_of_each_group(spark.createDataFrame(r, schema).repartition(n)).collect()), key=repr)
           for r, n in ((rows, 1), (rows[::-1], 7))]
    assert out[0] == out[1] and [r for r in out[0] if r[0] == 1] == [(1, BASE, "en", "s0", 0, None)]
    assert len(out[0]) == 4 and jaccard.one_of_each_group(spark.createDataFrame([], schema)).count() == 0


def test_marks_after_words_are_pieces_of_their_own():
    path = word_tokenizer()
    texts = ["the!! the... the## the, the. é, t|> b", "a<|endoftext|> b. ", "İ. i̇. É. x's, ", "", "ª ŉ µ½², \n the.\nthe", "中!! ǅ,, "]
    coder = simple8b._PieceEncoder(path, 2)
    want = [[*coder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [x.tolist() for x in coder.encode(texts)] == want and coder.encode([]) == []
    assert {"the", "!!", "...", "##"} <= coder.known.keys() and not {"the!!", "the...", "the##"} & coder.known.keys()


def test_texts_worked_on_together_share_no_window():
    word = lambda a, n: " ".join(f"w{i}" for i in range(a, a + n))
    texts = [None, word(0, 25), "", word(25, 19), word(44, 1), word(0, 30), " ", word(10, 20) + " x " + word(10, 20)]
    batch = pa.record_batch([pa.array(texts, pa.string()), pa.array(range(len(texts)), pa.int64())], ["text", "k"])
    rows = lambda some: sorted(zip(*[c.to_pylist() for c in pa.Table.from_batches(substrings._minimizer_rows(some)).columns]))
    alone = rows(batch.slice(i, 1) for i in range(len(texts)))
    assert rows([batch]) == alone and {k for _, k, _ in alone} == {1, 5, 7}
    hashes = substrings.WordHashes()
    found, starts = hashes(texts)
    assert starts.tolist() == [0, 0, 25, 25, 44, 45, 75, 75, 116] and len(found) == 116
    assert [len(s) for s in substrings._slices(batch, 3)] == [3, 3, 2] and len(list(substrings._slices(batch, 9, 1))) >= 5


def _direct_bytes(spark):
    jvm = spark._jvm
    pools = jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(
        jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
    return {pool.getName(): pool.getMemoryUsed() for pool in pools}["direct"]


def test_reading_a_stored_table_keeps_no_column_chunks_outside_the_heap(spark):
    # 24 MB that do not compress, in one file
    wide = spark.range(0, 24_000, 1, 1).select(F.expr(
        "unhex(concat_ws('', transform(sequence(1, 32), i -> sha2(concat(id, ' ', i), 256))))").alias("raw"))
    kept = stored(wide, "wide")
    before = _direct_bytes(spark)
    assert kept.agg(F.sum(F.length("raw"))).first()[0] == 24_000 * 1024
    assert _direct_bytes(spark) - before < 8_000_000


def test_steady_reads_leave_a_setting_of_the_session(spark):
    (name, value), = READING.items()
    for own, then in ((None, value), ("true", "true")):
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)
        try:
            steady_reads(spark)
            assert spark.conf.get(name) == then
        finally:
            spark.conf.unset(name)


def test_shingle_sets_hold_no_words(spark):
    sets = jaccard.ShingleSets(2)
    held = dict(vars(sets))
    first = sets("One two three")
    assert len(first) == 2 and (sets("one TWO three") == first).all() and len(sets(None)) == 0
    sets(" ".join(map(str, range(1000))))
    assert vars(sets) == held == {"n": 2}


def test_ngram_counters_of_all_tasks(spark):
    texts = [f"w{i % 7} w{i % 5} w{i % 3} w{i % 2}" for i in range(1300)] + [None, "", "alone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets, want = jaccard.ShingleSets(2), np.zeros(1 << jaccard.COUNTER_BITS, dtype=np.int64)
    for text in texts:
        for h in sets(text):
            want[int(h) >> 64 - jaccard.COUNTER_BITS] += 1
    assert (jaccard._frequencies(stored(jaccard._sets(docs, 2), "sets")) == want).all()
