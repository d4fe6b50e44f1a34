"""Secret spans against plain regular expressions and a plain battery."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from civgraph.llm import secrets

R = random.Random(8)
ENGLISH = """the quick brown fox jumps over lazy dog interdisciplinary approach uncharacteristically long words needed because people
write identifiers such as database connection manager factory configuration service provider handler request response message queue
worker thread pool executor context session transaction repository controller component interface abstract implementation""".split()
KINDS = {  # fixed values of the contract
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18), "hex": (r"[0-9a-f]+", 0, 16)}


def key(alphabet, n):
    return "".join(R.choice(secrets.ALPHABETS[alphabet]) for _ in range(n))


def joined(n, change=str):
    out = ""
    while len(out) < n:
        out += change(R.choice(ENGLISH))
    return out[:n]


def base(text):
    found = []
    for number, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        found += [(m.start(), number, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def tail(z):
    t = 1 / (1 + 0.2316419 * z)
    series = sum(c * t ** k for k, c in enumerate((0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429), 1))
    return math.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series


def p_value(token):
    alphabet = next((a for a, s in secrets.ALPHABETS.items() if set(token) <= set(s)), None)
    if alphabet is None:
        return None, None
    symbols = secrets.ALPHABETS[alphabet]
    m, n, c = len(symbols), len(token), [symbols.index(x) for x in token]
    chi = sum((c.count(k) - n / m) ** 2 / (n / m) for k in range(m))
    z1 = (np.cbrt(chi / (m - 1)) - (1 - 2 / (9 * (m - 1)))) / math.sqrt(2 / (9 * (m - 1)))
    changes = sum((2 * a >= m) != (2 * b >= m) for a, b in zip(c, c[1:]))
    z2 = abs(changes - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    mid = (m - 1) / 2
    z3 = abs(sum((a - mid) * (b - mid) for a, b in zip(c, c[1:]))) / ((m * m - 1) / 12 * math.sqrt(n - 1))
    return alphabet, max(1e-12, min(1, 3 * min(tail(z1) if z1 >= 0 else 1, 2 * tail(z2), 2 * tail(z3))))


def texts():
    out = [None, "", "password: 'short'", "Api_Key=abcDEF123456 token = 0123456789ab", "é AKIA" + "Z9" * 8 + " AKIA12",
           "deadbeef" * 4 + " deadbeef", "passwd=" + "a" * 12 + "secret:" + "b" * 11, "x" * 5000 + " " + "0f" * 40]
    for _ in range(150):
        out.append(" ".join([joined(R.randrange(10, 60), R.choice([str, str.capitalize, str.upper])), R.choice(ENGLISH),
                             key(R.choice(["base62", "base64", "base36", "base32", "hex", "HEX", "digits"]), R.randrange(12, 60)),
                             R.choice(["token=", "secret : ", "see "]) + key("base62", R.randrange(8, 30))]))
    return out


@pytest.fixture(scope="module")
def scanned(spark):
    rows = list(enumerate(texts())) + [(5, "deadbeef" * 4), (None, "AKIA" + "Q" * 20)]
    docs = spark.createDataFrame([(i, t, "s", "b", 1) for i, t in rows], "doc_id long, text string, spans string, base string, h long")
    return rows, secrets.secret_digest(docs.repartition(3)).collect()


def test_base_spans_and_digests(scanned):
    rows, got = scanned
    want = sorted((i is None, i or 0, hashlib.sha256(",".join(base(t)).encode()).hexdigest(), *[
        sum(s.startswith(k) for s in base(t)) for k in KINDS]) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got) == want
    by_id = {r.doc_id: r.spans.split(",") if r.spans else [] for r in got if r.doc_id != 5}
    for i, t in rows:
        if i != 5:
            assert set(base(t)) <= set(by_id[i])
            assert by_id[i] == sorted(by_id[i], key=lambda s: (int(s.split(":")[1]), ["assign", "access", "hex", "random"].index(s.split(":")[0])))


def test_battery_equals_plain_arithmetic(spark):
    tokens = sorted({key(a, n) for a in secrets.ALPHABETS for n in (20, 33, 70)} | {joined(n) for n in (20, 40, 80)} | {"a" * 30, "+-" * 12})
    runs = spark.createDataFrame([(t,) for t in tokens], "token string")
    got = {r.token: (r.alphabet, r.p) for r in secrets._p_values(runs).collect()}
    for t in tokens:
        alphabet, p = p_value(t)
        assert (t in got) == (alphabet is not None)
        if alphabet:
            assert got[t][0] == alphabet and got[t][1] == pytest.approx(p, rel=1e-4, abs=1e-9)


def test_refusals_follow_benjamini_and_hochberg(spark):
    """A refused step's upper end is allowed by the runs up to it, and no larger step is."""
    tokens = sorted({key("base62", R.randrange(32, 64)) for _ in range(200)} | {joined(R.randrange(32, 64), lambda w: w.capitalize() + "1")
                                                                                 for _ in range(200)})
    runs = spark.createDataFrame([(t,) for t in tokens], "token string")
    kept = {r.token for r in secrets.random_runs(runs).collect()}
    family = [(p_value(t)[1], t) for t in tokens if p_value(t)[0] == "base62"]
    steps = [math.floor(4 * math.log10(p)) for p, _ in family]
    refused = [s for s in set(steps) if 10 ** ((s + 1) / 4) <= secrets.FALSE_DISCOVERY * sum(x <= s for x in steps) / len(steps)]
    worst = max(refused, default=-10**9)
    assert kept & {t for _, t in family} == {t for (_, t), s in zip(family, steps) if s > worst}


def test_words_are_not_reported_and_keys_are(spark):
    plain = ["uncharacteristically", "interdisciplinaryapproach", "thequickbrownfoxjumpsoverlazydog", "INTERDISCIPLINARYAPPROACH"]
    words = plain + [joined(R.randrange(20, 120), R.choice([str, str.upper])) for _ in range(400)]
    words += [joined(R.randrange(48, 120), str.capitalize) for _ in range(100)]
    keys = [key(R.choice(["base62", "base64", "base36"]), R.randrange(32, 65)) for _ in range(400)]
    rows = [(i, f"see {w} here") for i, w in enumerate(words + keys)]
    got = {r.doc_id: r.spans for r in secrets.secret_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("random" not in got[i] for i in range(len(plain)))
    assert sum("random" in got[i] for i in range(len(words))) <= 0.03 * len(words)
    assert sum("random" in got[i] or "hex" in got[i] for i in range(len(words), len(rows))) >= 0.9 * len(keys)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, spans int")
    assert secrets.secret_digest(empty).count() == 0
    assert secrets.scan(empty.withColumn("text", F.lit(None).cast("string"))).columns == ["doc_id", "base", "spans"]
