"""Secret scans against Python's own expressions, and the randomness battery on planted tokens."""

import hashlib
import math
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from culprit.llm import secrets

SCHEMA = "doc_id long, text string, spans string"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def written(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


TEXTS = [
    None,
    "",
    "no secrets é here 😀 at all",
    "é😀 password = 'abcdefgh1' then PASSWD:short TOKEN=secret=abcdefghij",
    "secret=token: abcdefghij api_key: " + "x" * 50 + " apikey='" + "a" * 7,
    "AKIAABCDEFGHIJKL AKIA123 AKIA" + "B2" * 40 + "xAKIAABCDEFGHIJKLMN",
    "deadbeef" * 4 + " " + "0a" * 15 + " token = " + "0123456789abcdef" * 3 + "g" + "f" * 32,
    "password=abcdefgh" * 3 + "\n" + "word " * 30_000 + "secret: 12345678",
]


def test_base_spans(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, TEXTS[3], None)]
    got = secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base_spans(TEXTS[3 if r.doc_id is None else r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in want) for k in range(3))
        assert r.spans == written(want)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in secrets.find_secrets(docs).collect():
        assert r.base_sha256 == hashlib.sha256(written(base_spans(texts[r.doc_id])).encode()).hexdigest()


def test_random_tokens_are_found_and_words_are_not(spark, prose):
    draw = random.Random(5)
    long_words = ["".join(prose(1, draw.random()).split()[0] for _ in range(4)) for _ in range(4000)]
    rows, planted = [], {}
    for i in range(200):
        text = prose(20, i) + " " + " ".join(long_words[20 * i : 20 * i + 20])
        if i % 5 == 0:
            key = "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(28)) + "7q"
            planted[i] = (len(text) + 1, len(text) + 31)
            text += " " + key + " " + prose(5, i)
        if i % 7 == 1:
            text += " section1section1section1 aaaaaaaaaaaaaaaaaaa1 "
        rows.append((i, text, None))
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = [i for i, (start, end) in planted.items() if got[i].spans == f"random:{start}:{end}"]
    assert len(found) >= 0.75 * len(planted)
    assert sum(r.n_random for r in got.values()) <= len(planted) + 1


def log_tail(z):
    z = min(max(z, -12.0), 12.0)
    return -math.log1p(math.exp(0.07056 * z**3 + 1.5976 * z))


def plain_evidence(token):
    """The three tests by loops over numpy arrays."""
    digits, lower, upper = string.digits, string.ascii_lowercase, string.ascii_uppercase
    choices = [digits + lower[:6], digits + upper[:6], digits + lower, digits + upper, digits + upper + lower, digits + upper + lower + "+/_=-"]
    alphabet = next(a for a in choices if set(token) <= set(a))
    k, n, x = len(alphabet), len(token), np.array([alphabet.index(c) for c in token], float)
    spread = 2 / (9 * (k - 1))
    fit = (k / n * sum(token.count(c) ** 2 for c in set(token)) - n) / (k - 1)
    chi = (np.cbrt(fit) - (1 - spread)) / math.sqrt(spread)
    off = x - x.mean()
    vary = (off**2).sum()
    serial = abs((off[1:] * off[:-1]).sum() / vary) * math.sqrt(n) if vary > 1e-9 else math.sqrt(n)
    up = 2 * x >= k
    runs, wanted = 1 + (up[1:] != up[:-1]).sum(), 2 * up.sum() * (n - up.sum()) / n + 1
    width = (wanted - 1) * (wanted - 2) / (n - 1)
    apart = abs(runs - wanted) / math.sqrt(width) if width > 1e-9 else math.sqrt(n)
    return log_tail(chi) + log_tail(serial) + log_tail(apart) + 2 * math.log(2)


def test_evidence_equals_plain_loops(spark):
    draw = random.Random(3)
    kinds = (string.ascii_letters + string.digits, string.ascii_lowercase + "7", string.hexdigits[:16], "ab1", "thequickbrowN", "A")
    tokens = ["".join(draw.choice(a) for _ in range(n)) for n in (16, 24, 33, 64, 600) for a in kinds for _ in range(3)]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.evidence(F.col("t")).alias("e")).collect()
    assert len(got) == len(tokens) and all(abs(r.e - plain_evidence(r.t)) < 1e-9 for r in got)


def test_step_up_equals_the_rule_over_sorted_p_values():
    draw = random.Random(8)
    for _ in range(50):
        null = {c: [draw.choice([0, 0, 1, 30, 400]) for _ in range(81)] for c in (8, 9, 12)}
        mine = {c: [draw.choice([0, 0, 0, 1, 5]) * (5 if b < 4 else 1) for b in range(81)] for c in (8, 9, 12, 14)}
        p = {c: [(sum(null[c][: b + 1]) + 1) / (sum(null[c]) + 1) if c in null else 1.0 for b in range(81)] for c in mine}
        values = sorted(p[c][b] for c in mine for b in range(81) for _ in range(mine[c][b]))
        limit = max((v for i, v in enumerate(values, 1) if v <= 0.05 * i / len(values)), default=-1)
        want = {(c, b) for c in mine for b in range(81) if p[c][b] <= limit}
        last = secrets.step_up(null, mine, 0.05)
        assert {(c, b) for c in mine for b in range(last.get(c, -1) + 1)} == want


def test_keys_of_all_lengths_and_very_long_texts(spark, prose):
    draw = random.Random(9)
    make = lambda n: "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(n))
    rows, planted = [], {}
    for i in range(300):
        text, n = prose(60, i), (24, 28, 32, 40, 48, 64)[i % 6]
        if i % 2:
            planted[i] = f"random:{len(text) + 1}:{len(text) + 1 + n}"
            text += " " + make(n)
        rows.append((i, text, None))
    rows.append((1000, make(300_000), None))
    rows.append((1001, "token=abcdefgh12 " * 30_000, None))
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got[i].spans == want for i, want in planted.items()) >= 0.85 * len(planted)
    assert sum(r.n_random for i, r in got.items() if i not in planted and i < 1000) <= 2
    assert got[1000].spans == "random:0:300000" and got[1001].n_assign == 30_000


def test_empty_table(spark):
    empty = secrets.find_secrets(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
