"""Secret scans: base patterns and a battery of randomness tests, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culprit.llm.common import kept_table
from culprit.llm.spans import apart_from, bound, kept_as, span, with_matches, written_out

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
LEAST = 16
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
SHORT = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9]{{1,{LEAST - 1}}}+(?![A-Za-z0-9+/_=-])"
RATE = 0.05
BINS = 80
LAST_CLASS = 72
NULL_LETTERS = 1 << 19
STRUNG = 512  # short words in one string
KINDS = ("assign", "access", "hex")


def encoding(token: Column) -> Column:
    """The smallest alphabet of an encoding that has all characters of a token."""
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    choices = [
        (r"^[0-9a-f]+$", digits + lower[:6]), (r"^[0-9A-F]+$", digits + upper[:6]),
        (r"^[a-z0-9]+$", digits + lower), (r"^[A-Z0-9]+$", digits + upper), (r"^[A-Za-z0-9]+$", digits + upper + lower),
    ]
    out = F.lit(digits + upper + lower + "+/_=-")
    for pattern, alphabet in reversed(choices):
        out = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(out)
    return out


def _log_tail(z: Column) -> Column:
    """Logarithm of the upper tail of the normal distribution, by a logistic fit."""
    inside = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return bound(inside, lambda x: -F.log1p(F.exp(0.07056 * x * x * x + 1.5976 * x)))


def evidence(token: Column) -> Column:
    """Sum of the log p-values of three tests that the characters are drawn evenly and apart.

    Chi-squared of the character counts over the inferred alphabet (Wilson and Hilferty's cube
    root), Wald and Wolfowitz's runs above and below the middle of the alphabet, and the serial
    correlation of neighbouring ranks. Near zero for random strings, far below for words.
    Alphabet and ranks are worked out once; the time is in proportion to the length.
    """
    return bound(F.struct(token.alias("token"), encoding(token).alias("alphabet"), _letters(token).alias("letters")), _with_ranks)


def _letters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _with_ranks(t: Column) -> Column:
    """The numbers that the tests need, each from one pass by a built-in function."""
    token, alphabet = t["token"], t["alphabet"]
    ranks = F.transform(t["letters"], lambda c: F.instr(alphabet, c) - 1)
    counts = F.transform(F.array_distinct(t["letters"]), lambda c: F.length(token) - F.length(F.replace(token, c, F.lit(""))))
    half = F.ceil(F.length(alphabet) / 2).cast("int")
    bits = F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), F.length(alphabet) - half))
    halves = F.call_function("translate", token, alphabet, bits)
    return bound(F.struct(F.length(alphabet).alias("k"), ranks.alias("ranks"), counts.alias("counts"), halves.alias("halves")), _tests)


def _tests(t: Column) -> Column:
    ranks, counts, halves = t["ranks"], t["counts"], t["halves"]
    k, n = t["k"].cast("double"), F.size(ranks).cast("double")
    zero = F.lit(0.0)

    def total(values: Column, power: int = 1) -> Column:
        return F.aggregate(values, zero, (lambda s, v: s + v) if power == 1 else (lambda s, v: s + v.cast("double") * v))

    sums = {
        "k": k,
        "n": n,
        "squares": total(counts, 2),
        "mean": total(ranks) / n,
        "power": total(ranks, 2),
        "cross": total(F.zip_with(F.slice(ranks, 2, F.size(ranks)), F.slice(ranks, 1, F.size(ranks) - 1), lambda x, y: x.cast("double") * y)),
        "ends": F.get(ranks, F.lit(0)) + F.element_at(ranks, -1),
        "high": n - F.length(F.replace(halves, F.lit("1"), F.lit(""))),
        "runs": 1 + 2 * n - F.length(F.replace(halves, F.lit("01"), F.lit("0"))) - F.length(F.replace(halves, F.lit("10"), F.lit("1"))),
    }
    return bound(F.struct(*[value.alias(name) for name, value in sums.items()]), _combined)


def _combined(s: Column) -> Column:
    k, n, mean, high = s["k"], s["n"], s["mean"], s["high"]
    spread = 2 / (9 * (k - 1))
    chi = (F.pow((k / n * s["squares"] - n) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    vary = s["power"] - n * mean * mean
    together = s["cross"] - mean * (2 * n * mean - s["ends"]) + (n - 1) * mean * mean
    serial = F.when(vary > 1e-9, F.abs(together / vary) * F.sqrt(n)).otherwise(F.sqrt(n))
    wanted = 2 * high * (n - high) / n + 1
    width = (wanted - 1) * (wanted - 2) / (n - 1)
    apart = F.when(width > 1e-9, F.abs(s["runs"] - wanted) / F.sqrt(width)).otherwise(F.sqrt(n))
    return _log_tail(chi) + _log_tail(serial) + _log_tail(apart) + 2 * math.log(2)


def length_class(length: Column) -> Column:
    """Eighths of an octave of the length up to 64, half octaves to 512, and all beyond together."""
    octaves = F.log2(length.cast("double"))
    return F.least(F.when(length < 64, F.floor(octaves * 8)).otherwise(F.floor(octaves * 2) * 4), F.lit(LAST_CLASS)).cast("int")


def evidence_bin(token: Column) -> Column:
    """Evidence in half units from 0 (most random) to ``BINS``."""
    return F.least(F.floor(-2 * evidence(token)), F.lit(BINS)).cast("int")


def candidate(token: Column) -> Column:
    """Letters and digits together, or letters in both cases, and none of the base patterns."""
    mixed = (token.rlike("[A-Za-z]") & token.rlike("[0-9]")) | (token.rlike("[A-Z]") & token.rlike("[a-z]"))
    return mixed & ~token.rlike(rf"{HEX}|AKIA[A-Z0-9]{{12}}")


def null_strings(docs: DataFrame, classes: list[int], text: str = "text") -> DataFrame:
    """``class`` and ``t``: the short words of the table strung together to the length of a class.

    Words are the distinct runs of letters and digits that are too short for a candidate. Each
    is dealt to one of the classes by hash. In an order by hash the words of a class are
    written one behind the other and cut into pieces of its least length, so all words are
    used and there are as many pieces at lengths that no word has. Where the classes would get
    fewer than ``NULL_LETTERS`` letters the vocabulary is dealt and strung again in other
    orders, so that small p-values can be told apart.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = docs.select(F.explode_outer(F.regexp_extract_all(body, F.lit(SHORT), F.lit(0))).alias("w"))
    words = kept_table(words.filter("w IS NOT NULL").distinct(), "short-words")
    size = words.agg(F.count("*").alias("n"), F.sum(F.length("w")).alias("letters")).first()
    letters = size["letters"] or 0
    rounds = math.ceil(NULL_LETTERS * len(classes) / max(1, letters)) if size["n"] else 1
    lengths = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(math.ceil(2 ** (c / 8))).alias("long")) for c in classes])
    strung = words.select("w", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))
    dealt = F.get(lengths, F.pmod(F.xxhash64(F.lit(2), "w", "round"), F.lit(len(classes))).cast("int"))
    part = F.pmod(F.xxhash64(F.lit(1), "w", "round"), F.lit(rounds * size["n"] // (STRUNG * len(classes)) + 1))
    strung = strung.select("w", F.xxhash64("w", "round").alias("h"), part.alias("part"), dealt.alias("c"))
    strung = strung.repartition(max(32, rounds * letters >> 17), "c", "part")
    ordered = F.array_sort(F.collect_list(F.struct("h", "w")))
    strung = strung.groupBy("c", "part").agg(F.array_join(F.transform(ordered, lambda s: s["w"]), "").alias("all"))
    cuts = strung.select("all", "c.class", "c.long").filter(F.length("all") >= F.col("long"))
    starts = F.sequence(F.lit(1), F.length("all") - F.col("long") + 1, F.col("long"))
    return cuts.select("class", "all", "long", F.explode(starts).alias("at")).select("class", F.substr("all", F.col("at"), F.col("long")).alias("t"))


def step_up(null: dict[int, list[int]], mine: dict[int, list[int]], rate: float) -> dict[int, int]:
    """For each class the last bin that is called random, by Benjamini and Hochberg's rule.

    The p-value of a candidate is the share of the null strings of its class that are at least
    as random. The p-values of all classes are stepped through together: the largest that is
    at most ``rate`` times the share of candidates at or below it is the limit of all.
    """
    p_values: dict[int, list[float]] = {}
    counts: dict[float, int] = {}
    for c, bins in mine.items():
        below, all_null, p_values[c] = 0, sum(null.get(c, [])), []
        for b, n in enumerate(bins):
            below += null[c][b] if c in null else 0
            p_values[c].append((below + 1) / (all_null + 1))
            if n:
                counts[p_values[c][b]] = counts.get(p_values[c][b], 0) + n
    total, seen, limit = sum(counts.values()), 0, -1.0
    for p in sorted(counts):
        seen += counts[p]
        if p <= rate * seen / total:
            limit = p
    last = {c: max((b for b, p in enumerate(ps) if p <= limit), default=-1) for c, ps in p_values.items()}
    return {c: b for c, b in last.items() if b >= 0}


def thresholds(docs: DataFrame, text: str = "text", rate: float = RATE) -> dict[int, int]:
    """For each length class the last evidence bin that is called random (see ``step_up``).

    All distinct candidates of all documents are tested against strings of all its short
    words; what reaches the driver is one row per class and bin.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    tokens = docs.select(F.explode_outer(F.regexp_extract_all(body, F.lit(TOKEN), F.lit(0))).alias("t"))
    tokens = tokens.filter("t IS NOT NULL").filter(candidate(F.col("t"))).distinct()
    mine = _by_bin(tokens.select(length_class(F.length("t")).alias("class"), "t"))
    return step_up(_by_bin(null_strings(docs, sorted(mine), text)) if mine else {}, mine, rate)


def _by_bin(tokens: DataFrame) -> dict[int, list[int]]:
    """How many of the strings fall into each bin, by class."""
    out: dict[int, list[int]] = {}
    for r in tokens.select("class", evidence_bin(F.col("t")).alias("bin")).groupBy("class", "bin").agg(F.count("*").alias("n")).collect():
        out.setdefault(r["class"], [0] * (BINS + 1))[r["bin"]] = r["n"]
    return out


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and all spans, one row per row.

    Base kinds are ``assign``, ``access`` and ``hex``. The battery adds ``random``: runs of
    sixteen or more characters of an encoding, with letters and digits or both cases, that pass
    the randomness tests at their length and overlap no base span. A null text is empty. Repeated
    rows give equal rows; a null id stays null; other columns are not read.
    """
    limits = thresholds(docs, text, rate)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("random", TOKEN)):
        rows = with_matches(rows, "_text", pattern, f"_{name}")
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    rows = rows.withColumns(
        {
            "_assign": kept_as("_assign", "assign", 0, long_value),
            "_access": kept_as("_access", "access", 1, lambda m: F.length(m) >= LEAST),
            "_hex": kept_as("_hex", "hex", 2, lambda m: F.lit(True)),
            "_random": F.filter("_random", lambda m: candidate(m["found"])),
        }
    ).drop("_text")
    rows = rows.withColumn("_base", F.concat("_assign", "_access", "_hex"))
    rows = rows.withColumn("_random", apart_from("_random", ["_assign", "_access", "_hex"]))
    passes = F.lit(False)
    at = F.filter("_random", lambda m: _passes(m["found"], limits)) if limits else F.filter("_random", lambda m: passes)
    rows = rows.withColumn("_more", F.transform(at, lambda m: span(m["start"], m["end"], "random", 3)))
    base = written_out(F.col("_base"))
    return rows.select(
        "doc_id",
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        written_out(F.concat("_base", "_more")).alias("spans"),
        F.size("_more").cast("long").alias("n_random"),
    )


def _passes(token: Column, limits: dict[int, int]) -> Column:
    limit = F.get(F.array(*[F.lit(limits.get(c, -1)) for c in range(LAST_CLASS + 1)]), length_class(F.length(token)))
    return (limit >= 0) & (evidence_bin(token) <= limit)
