"""Benchmark decontamination by canonical templates and slot consistency."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from culprit.llm.common import kept_table, texts_of, word_blocks

WINDOW = 8
FEWEST = 4
COVERAGE = 0.5
LONGEST_RUN = 32
FILTER_BITS = 1 << 22
VOCABULARY_BYTES = 32 << 20

# Words that stand for numbers, and units of measure.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen".split()
UNITS = "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees km/h mph".split()

EDGES = b"\"'()[]{}<>.,;:!?*_`"
CLOSING = b")]}.,;:!?"
DIGITS = re.compile(rb"[+-]?[$]?[0-9]+(?:[.,:/][0-9]+)*(%|[a-z]{1,3})?$")
PLACEHOLDERS = {"number": b"<number>", "unit": b"<unit>", "name": b"<name>"}


def folded(bare: bytes) -> bytes:
    """A word without its case, in any script."""
    if bare.isascii():
        return bare.lower()
    return bare.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")


def capitalised(bare: bytes) -> bool:
    word = bare.decode("utf-8", "surrogateescape")
    return word[:1].isupper() and word[1:].islower()


def _upper(bare: bytes) -> bool:
    """Two or more characters, the first in upper case."""
    if bare < b"\x80":
        return b"A" <= bare < b"[" and len(bare) > 1
    word = bare.decode("utf-8", "surrogateescape")
    return len(word) > 1 and word[0].isupper()


class Canon:
    """Canonical form of a token, given the benchmark's names and its other words.

    A number, in figures or words, a unit and a name become typed placeholders; all else is
    the token in lower case without punctuation at its edges. Words of the benchmark have the
    same form in any case; others are names where they are capitalised. The form depends on
    the token alone, so it is the same on both sides.
    """

    def __init__(self, known: set[bytes], names: set[bytes]):
        self.known, self.names = known, names
        # Forms of the words that have one whatever their case; the first of numbers, units and names holds.
        self.fixed = {w: w for w in known}
        self.fixed |= dict.fromkeys(names, PLACEHOLDERS["name"])
        self.fixed |= dict.fromkeys((w.encode() for w in UNITS), PLACEHOLDERS["unit"])
        self.fixed |= dict.fromkeys((w.encode() for w in NUMBERS), PLACEHOLDERS["number"])
        self.fixed |= {w: PLACEHOLDERS["number"] for w in self.fixed if DIGITS.match(w)}

    def __call__(self, token: bytes) -> bytes:
        bare = token.strip(EDGES)
        low = folded(bare)
        form = self.fixed.get(low)
        if form is not None:
            return form
        if DIGITS.match(low):
            return PLACEHOLDERS["number"]
        return PLACEHOLDERS["name"] if _upper(bare) else low


def known_words(texts: list[str]) -> tuple[set[bytes], set[bytes]]:
    """Words of the benchmark in lower case, and those that it only has capitalised: its names."""
    bare = {t.strip(EDGES) for text in texts for t in text.encode().split()}
    names = {folded(w) for w in bare if capitalised(w)}
    known = {folded(w) for w in bare if not capitalised(w)}
    return known, names - known


class Numbered(dict):
    """Token -> number of its canonical form in the benchmark, 0 for others.

    Slots are negative: minus twice the number, and one less where punctuation closes the token.
    """

    MOST = 300_000

    def __init__(self, canon: Canon, vocabulary: dict[bytes, int]):
        slots = {form: -2 * vocabulary[form] for form in PLACEHOLDERS.values() if form in vocabulary}
        self.fixed = {low: slots.get(form, vocabulary.get(form, 0)) for low, form in canon.fixed.items()}
        self.digits, self.named = (slots.get(PLACEHOLDERS[kind], 0) for kind in ("number", "name"))

    def __missing__(self, token: bytes) -> int:
        """As ``canon`` has it; a word that is neither fixed nor a slot is not in the benchmark."""
        if len(self) >= self.MOST:
            self.clear()
        bare = token.strip(EDGES)
        low = bare.lower() if bare.isascii() else folded(bare)
        out = self.fixed.get(low)
        if out is None:
            # Figures begin with a byte below the colon.
            out = self.digits if low < b":" and DIGITS.match(low) else self.named if _upper(bare) else 0
        if out < 0:
            out -= token[-1:] in CLOSING
        self[token] = out
        return out


def runs_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and numbers of the runs: neighbouring slots of one kind are one slot.

    Punctuation ends a run, and so do ``LONGEST_RUN`` tokens.
    """
    if not len(numbers):
        return np.zeros(0, np.int64), numbers
    kind = np.where(numbers < 0, -(-numbers // 2), numbers)
    closed = (numbers < 0) & (numbers % 2 != 0)
    fresh = np.concatenate([[True], (kind[1:] >= 0) | (kind[1:] != kind[:-1]) | closed[:-1]])
    places = np.arange(len(numbers))
    fresh |= (places - np.maximum.accumulate(np.where(fresh, places, 0))) % LONGEST_RUN == 0
    starts = np.flatnonzero(fresh)
    return starts, kind[starts]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """64 well-spread bits of each vocabulary number."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def window_hashes(numbers: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows of known tokens with enough words between the slots, and their hashes."""
    if len(numbers) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = lambda flags: np.convolve(flags, np.ones(width, np.int64), "valid")
    good = (sums((numbers == 0).astype(np.int64)) == 0) & (sums((numbers > 0).astype(np.int64)) >= FEWEST)
    places = np.flatnonzero(good)
    if not len(places):
        return places, np.zeros(0, np.int64)
    mixed = _mixed(np.abs(numbers))
    out = np.full(len(places), width, np.uint64)
    for i in range(width):
        out = (out * np.uint64(0xFF51AFD7ED558CCD)) ^ mixed[places + i]
        out ^= out >> np.uint64(31)
    return places, out.view(np.int64)


def _slots(words: list[bytes], starts: np.ndarray, numbers: np.ndarray, place: int, width: int) -> list[str]:
    """The values of the slots of a window, in lower case."""
    stop = lambda i: starts[i + 1] if i + 1 < len(starts) else len(words)
    value = lambda i: b" ".join(w.strip(EDGES) for w in words[starts[i] : stop(i)])
    return [value(i).decode("utf-8", "replace").casefold() for i in range(place, place + width) if numbers[i] < 0]


def benchmark_windows(items: list[tuple], numbered: Numbered) -> list[tuple]:
    """(item_id, place, width, hash, slots) of all windows; an item shorter than a window is one.

    Items with fewer than ``FEWEST`` words outside slots have no window and never match.
    """
    out = []
    for item, text in items:
        words = (text or "").encode().split()
        starts, numbers = runs_of(np.fromiter(map(numbered.__getitem__, words), np.int64, len(words)))
        width = min(WINDOW, len(numbers))
        if width < FEWEST:
            continue
        places, hashes = window_hashes(numbers, width)
        out += [(item, int(p), width, int(h), _slots(words, starts, numbers, p, width)) for p, h in zip(places, hashes, strict=True)]
    return out


def document_windows(docs: DataFrame, canon: Canon, vocabulary: dict[bytes, int], passing: np.ndarray, widths: list[int]) -> DataFrame:
    """(_id, _body, place, width, hash, slots) of the windows that pass the benchmark's filter.

    Places count runs. The last run of a block may go on in the next, so it is read there.
    """
    shared = docs.sparkSession.sparkContext.broadcast((canon, vocabulary, passing, widths))
    longest = max(widths)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon, vocabulary, passing, widths = shared.value
        numbered = Numbered(canon, vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            offsets, data = texts_of(batch.column(2))
            for r, (start, stop) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                carry, at, had = [], 0, 0
                blocks = word_blocks(data[start:stop].tobytes())
                block = next(blocks, None)
                while block is not None:
                    after = next(blocks, None)
                    words = carry + block if carry else block
                    starts, numbers = runs_of(np.fromiter(map(numbered.__getitem__, words), np.int64, len(words)))
                    whole = len(numbers) - (after is not None and len(numbers) > 0)
                    for width in widths:
                        places, hashes = window_hashes(numbers[:whole], width)
                        if not len(places):
                            continue
                        bit = hashes.view(np.uint64) % np.uint64(FILTER_BITS)
                        near = (passing[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        near &= places + width > had  # windows within the carried runs were seen before
                        rows += [(r, at + int(p), width, int(h), _slots(words, starts, numbers, p, width)) for p, h in zip(places[near], hashes[near], strict=True)]
                    first = max(0, whole - longest + 1)
                    carry = words[starts[first] :] if after is not None and len(starts) else []
                    at, had, block = at + first, whole - first, after
            if rows:
                r, place, width, hashes, slots = zip(*rows, strict=True)
                which = pa.array(r, pa.int64())
                columns = [batch.column(0).take(which), batch.column(1).take(which), pa.array(place, pa.int64()), pa.array(width, pa.int32()), pa.array(hashes, pa.int64()), pa.array(slots, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_body", "place", "width", "hash", "slots"])

    return docs.mapInArrow(scan, "_id long, _body long, place long, width int, hash long, slots array<string>")


def longest_chain(pairs: list[tuple]) -> list[tuple]:
    """Most of the (offset, q, width, own, slots) that lie in one order in the item and the document."""
    pairs = sorted(pairs, key=lambda p: (p[1], -p[0]))
    tails, ends, before = [], [], []
    for n, (offset, q, *_) in enumerate(pairs):
        i = bisect_left(tails, offset + q)
        tails[i : i + 1], ends[i : i + 1] = [offset + q], [n]
        before.append(ends[i - 1] if i else -1)
    out, n = [], ends[-1]
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _covered(places: list[int], width: int) -> int:
    """How many places the windows at sorted ``places`` cover."""
    return width + sum(min(width, b - a) for a, b in zip(places, places[1:], strict=False))


def _same_value(own: str, other: str) -> bool:
    """Equal, or one with more words before or after it."""
    short, long = sorted((own, other), key=len)
    return own == other or f" {long} ".startswith(f" {short} ") or f" {long} ".endswith(f" {short} ")


def judged(pairs: list[tuple], of: int, cover: int) -> tuple[int, int, float] | None:
    """(windows, -changed, coverage) of a chain, or nothing where an item value has several values.

    Coverage is the share of the item's windows, or of its runs covered by windows, less the
    width on both sides: the windows across an insertion do not count as lost.
    """
    values: dict[str, str] = {}
    for _, _, _, own, slots in pairs:
        for mine, other in zip(own, slots, strict=True):
            other = mine if _same_value(mine, other) else other
            if values.setdefault(mine, other) != other:
                return None
    width, places = pairs[0][2], [p[1] for p in pairs]
    share = (_covered(places, width) - width + 1) / (cover - width + 1)
    return len(pairs), -sum(a != b for a, b in values.items()), max(len(pairs) / of, share)


def best_chain(pairs: list[tuple], of: int, cover: int, coverage: float) -> tuple[int, int, float] | None:
    """The best chain over one offset, two neighbouring ones or all of them."""
    offsets = sorted({p[0] for p in pairs})
    spans = {(a, a) for a in offsets} | set(zip(offsets, offsets[1:], strict=False)) | {(offsets[0], offsets[-1])}
    found = (judged(longest_chain([p for p in pairs if low <= p[0] <= high]), of, cover) for low, high in spans)
    return max((f for f in found if f and f[2] >= coverage), default=None)


def chains(pairs: DataFrame, coverage: float) -> DataFrame:
    """The best chain of each document, item and band of offsets."""

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept, out = [], []
            for n, (of, cover, group) in enumerate(zip(frame["of"], frame["cover"], frame["pairs"], strict=True)):
                group = [(p["offset"], p["q"], p["width"], tuple(p["own"]), tuple(p["slots"])) for p in group]
                if best := best_chain(group, of, cover, coverage):
                    kept.append(n)
                    out.append(best)
            rows = frame.iloc[kept][["_id", "_body", "item_id"]].reset_index(drop=True)
            yield rows.join(pd.DataFrame(out, columns=["n_windows", "kept", "coverage"]))

    return pairs.mapInPandas(judge, "_id long, _body long, item_id long, n_windows long, kept int, coverage double")


def matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", question: str = "text", coverage: float = COVERAGE,
    most: int = VOCABULARY_BYTES,
) -> DataFrame:
    """Contaminated documents: ``_id``, ``_body``, ``item_id``, ``n_windows``, ``coverage``, ``changed``.

    Windows of eight canonical runs are joined by hash and chained in the order of both sides,
    where offsets drift by at most eight runs or a quarter of the item. A chain counts when it
    covers at least ``coverage`` of the item and its slots are consistent: equal values of the
    item have equal values in the document. ``changed`` is the number of item values that
    have another value in the document.

    The benchmark's words are sent to the tasks; one of more than ``most`` characters is
    matched in parts by hash of the item, each with its own words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.xxhash64(F.col(text)).alias("_body"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    schema = "_id long, _body long, item_id long, n_windows long, coverage double, changed int"
    size = benchmark.agg(F.sum(F.length(question))).first()[0] or 0
    if size > most:
        parts = 2 * (size // most + 1)
        share = F.pmod(F.xxhash64(item), F.lit(parts))
        found = [matches(docs, benchmark.filter(share == p), key, text, item, question, coverage, 1 << 62) for p in range(parts)]
        return reduce(DataFrame.unionByName, found)
    items = [(r[0], r[1]) for r in benchmark.select(F.col(item).cast("long"), F.col(question).cast("string")).collect()]
    canon = Canon(*known_words([t for _, t in items if t]))
    forms = sorted({canon(w) for _, t in items if t for w in t.encode().split()})
    vocabulary = {form: i + 1 for i, form in enumerate(forms)}
    own = benchmark_windows(sorted(set(items), key=str), Numbered(canon, vocabulary))
    if not own:
        return spark.createDataFrame([], schema)
    passing = np.zeros(FILTER_BITS // 8, np.uint8)
    bits = np.array([w[3] for w in own], np.int64).view(np.uint64) % np.uint64(FILTER_BITS)
    np.bitwise_or.at(passing, bits >> np.uint64(3), (1 << (bits & np.uint64(7))).astype(np.uint8))
    theirs = spark.createDataFrame(own, "item_id long, q long, width int, hash long, own array<string>")
    item_of = Window.partitionBy("item_id")
    step = F.col("q") - F.lag("q").over(item_of.orderBy("q"))
    theirs = theirs.withColumn("step", F.least(F.coalesce(step, "width"), "width"))
    theirs = theirs.withColumns({"of": F.count("*").over(item_of), "cover": F.sum("step").over(item_of)}).drop("step")
    found = document_windows(rows, canon, vocabulary, passing, sorted({w[2] for w in own}))
    pairs = found.join(theirs, ["hash", "width"]).filter(F.size("own") == F.size("slots"))
    # Offsets at most a drift apart share a band of two drifts.
    drift = F.greatest(F.lit(WINDOW).cast("long"), F.floor(F.col("cover") / 4))
    pairs = pairs.withColumn("offset", F.col("place") - F.col("q")).withColumn("band", F.floor(F.col("offset") / drift))
    pairs = pairs.withColumn("band", F.explode(F.array("band", F.col("band") - 1)))
    pair = F.struct("offset", "q", "width", "own", "slots")
    pairs = pairs.groupBy("_id", "_body", "item_id", "band").agg(
        F.collect_set(pair).alias("pairs"), F.count_distinct("q").alias("n"), F.max("of").alias("of"), F.max("cover").alias("cover"), F.max("width").alias("w")
    )
    reach = F.greatest(F.col("n") / F.col("of"), (F.least(F.col("n") * F.col("w"), "cover") - F.col("w") + 1) / (F.col("cover") - F.col("w") + 1))
    pairs = chains(pairs.filter(reach >= coverage).select("_id", "_body", "item_id", "of", "cover", "pairs"), coverage)
    best = F.struct("n_windows", "kept", "coverage")
    out = pairs.groupBy("_id", "_body", "item_id").agg(F.max(best).alias("b"))
    return out.select("_id", "_body", "item_id", "b.n_windows", "b.coverage", (-F.col("b.kept")).alias("changed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``n_windows``, ``coverage`` and ``changed`` of each finding.

    Texts that are null or empty, and benchmark items without enough words, match nothing.
    Rows that repeat an id with another text each give their findings; identical rows give
    them once. A null id stays null. Other columns are not read.
    """
    return matches(docs, benchmark, key, text).withColumnRenamed("_id", "doc_id").drop("_body")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without findings, with all their columns."""
    found = kept_table(matches(docs, benchmark, key, text).select("_id", "_body").distinct(), "contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("body"))
    same = rows["id"].eqNullSafe(found["_id"]) & (rows["body"] == found["_body"])
    return rows.join(found, same, "left_anti").select("row.*")
