"""Spelling variants: words one edit apart, found by search schemes on a bidirectional FM-index.

Two words one edit apart agree in the first or in the second half of either of them. The
vocabulary is dealt by half-words into indexes of bounded size; each query meets the index
that holds all words with its first half, and the one that holds all with its second. There
that half is matched exactly and the match is extended over the other half with one error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culprit.llm.common import LOWER, UPPER, kept_table

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, RAREST = 6, 5
CHANGED = 199  # a run loses a code point where this divides its hash
RATIO = 5  # how much commoner a form is than its variant
INDEX_WORDS = 16_000
QUERY_WORDS = 2_000  # queries searched side by side in a task


class Ranks:
    """Counts of symbols in prefixes of an array: one array of running bit counts per symbol bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        counts = np.bincount(symbols, minlength=1 << bits)
        start = np.concatenate([[0], np.cumsum(counts)[:-1]])
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int64)
            zeros = len(symbols) - int(ones[-1])
            self.levels.append((b, ones, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(1 << bits)
        first = np.zeros_like(every)
        self.shift = start - self.follow(every, first, first)[0]

    def follow(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the rows [low, high) that hold ``c`` lie in bit order, and how many hold less."""
        less = np.zeros_like(low)
        for b, ones, zeros in self.levels:
            bit = (c >> b) & 1 == 1
            ones_low, ones_high = ones[low], ones[high]
            zeros_low, zeros_high = low - ones_low, high - ones_high
            less = less + np.where(bit, zeros_high - zeros_low, 0)
            low = np.where(bit, zeros + ones_low, zeros_low)
            high = np.where(bit, zeros + ones_high, zeros_high)
        return low, high, less

    def step(self, c: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of suffixes after one more symbol, and how many have a smaller one."""
        low, high, less = self.follow(c, low, low + size)
        return low + self.shift[c], high - low, less

    def children(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every symbol that occurs in each interval: (interval, symbol, low, size, less)."""
        which, high = np.arange(len(low)), low + size
        c, less = np.zeros_like(low), np.zeros_like(low)
        for b, ones, zeros in self.levels:
            ones_low, ones_high = ones[low], ones[high]
            zeros_low, zeros_high = low - ones_low, high - ones_high
            left, right = zeros_high > zeros_low, ones_high > ones_low
            which = np.concatenate([which[left], which[right]])
            c = np.concatenate([c[left], c[right] | (1 << b)])
            less = np.concatenate([less[left], (less + zeros_high - zeros_low)[right]])
            low = np.concatenate([zeros_low[left], (zeros + ones_low)[right]])
            high = np.concatenate([zeros_high[left], (zeros + ones_high)[right]])
        return which, c, low + self.shift[c], high - low, less


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start places of the rotations of a text in order, by doubling the compared length."""
    rank, reach = text.astype(np.int64), 1
    while True:
        key = rank * (len(text) + int(text.max()) + 1) + np.roll(rank, -reach)
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.diff(key[order]) != 0])
        rank[order] = np.cumsum(steps)
        if rank[order[-1]] == len(text) - 1:
            return order
        reach *= 2


@dataclass
class States:
    """Matches in progress: the query, the place of its next symbol, and intervals in both indexes."""

    query: np.ndarray
    at: np.ndarray
    low: np.ndarray  # in the index of the text
    back: np.ndarray  # in the index of the reversed text
    size: np.ndarray

    def pick(self, rows: np.ndarray) -> States:
        return States(self.query[rows], self.at[rows], self.low[rows], self.back[rows], self.size[rows])

    @staticmethod
    def joined(parts: list[States]) -> States:
        return States(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("query", "at", "low", "back", "size")])


class Lexicon:
    """Bidirectional FM-index over distinct words, each led by a delimiter smaller than all letters."""

    def __init__(self, words: list[str], letters: np.ndarray):
        self.words, self.letters = sorted(words), letters
        codes, starts = self.codes("".join("\0" + w for w in self.words)), len(self.words)
        bits = max(1, int(len(letters) + 1).bit_length())
        self.length, self.count = len(codes), starts
        self.left = Ranks(np.roll(codes, 1)[suffix_order(codes)], bits)
        codes = codes[::-1]
        self.right = Ranks(np.roll(codes, 1)[suffix_order(codes)], bits)

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        return np.where(points == 0, 0, np.searchsorted(self.letters, points) + 1).astype(np.int64)

    def extended(self, s: States, c: np.ndarray, right: bool, move: int) -> States:
        """Matches with one more symbol on the given side; those without any are dropped."""
        if right:
            back, size, less = self.right.step(c, s.back, s.size)
            low = s.low + less
        else:
            low, size, less = self.left.step(c, s.low, s.size)
            back = s.back + less
        return States(s.query, s.at + move, low, back, size).pick(size > 0)

    def every_extension(self, s: States, right: bool) -> tuple[States, np.ndarray]:
        """Matches with one more letter, whichever occurs, and that letter."""
        if right:
            which, c, back, size, less = self.right.children(s.back, s.size)
            low = s.low[which] + less
        else:
            which, c, low, size, less = self.left.children(s.low, s.size)
            back = s.back[which] + less
        letter = c > 0
        return States(s.query[which], s.at[which], low, back, size).pick(letter), c[letter]

    def near(self, queries: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word of this index) exactly one edit apart that agree in one half of the query.

        With ``right`` the first half is matched and the error lies to the right of it, else
        the second half and the left. The first half has floor(length / 2) letters.
        """
        text = self.codes("".join(queries))
        length = np.array([len(q) for q in queries], dtype=np.int64)
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        half = length // 2
        query = np.arange(len(queries))
        zero = np.zeros(len(queries), dtype=np.int64)
        # The half is matched towards the end of the word and then its delimiter.
        s = States(query, half - 1 if right else half, zero, zero, zero + self.length)
        stop = zero - 1 if right else length
        toward = not right
        delimited = []
        while len(s.query):
            done = s.at == stop[s.query]
            if done.any():
                ends = s.pick(done)
                delimited.append(self.extended(ends, np.zeros_like(ends.at), toward, 0))
                s = s.pick(~done)
            s = self.extended(s, text[start[s.query] + s.at], toward, 1 if toward else -1)
        # From there across the other half, without an error so far.
        s = States.joined([*delimited, s])
        if not len(s.query):
            return zero[:0], zero[:0]
        s.at = half[s.query] if right else half[s.query] - 1
        move = 1 if right else -1
        last = length if right else zero - 1  # the place of the far delimiter
        erred = []
        while len(s.query):
            inserted, c = self.every_extension(s, right)
            erred.append(inserted)
            inside = inserted.at != last[inserted.query]
            replaced, c = inserted.pick(inside), c[inside]
            replaced = replaced.pick(c != text[start[replaced.query] + replaced.at])
            erred.append(States(replaced.query, replaced.at + move, replaced.low, replaced.back, replaced.size))
            s = s.pick(s.at != last[s.query])
            erred.append(States(s.query, s.at + move, s.low, s.back, s.size))
            s = self.extended(s, text[start[s.query] + s.at], right, move)
        # The rest has no error and ends at the delimiter; the first rows are the delimiters, in word order.
        s, found = States.joined(erred), []
        while len(s.query):
            done = s.at == last[s.query]
            ends = s.pick(done)
            found.append(self.extended(ends, np.zeros_like(ends.at), right, 0))
            s = s.pick(~done)
            s = self.extended(s, text[start[s.query] + s.at], right, move)
        ends = States.joined([*found, s])
        pairs = np.unique(ends.query * self.count + ends.low)
        return pairs // self.count, pairs % self.count


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one index and its queries: the number of near words of each query and the commonest of them."""
    right = bool(rows["side"].iat[0] == 0)
    index = rows[rows["indexed"]].drop_duplicates("word").sort_values("word")
    queries = rows[~rows["indexed"]]
    out = pd.DataFrame({"word": pd.Series(dtype=str), "n_near": pd.Series(dtype=np.int64), "least": pd.Series(dtype=np.int64), "form": pd.Series(dtype=str)})
    if not len(index) or not len(queries):
        return out
    points = np.frombuffer("".join(rows["word"]).encode("utf-32-le"), dtype="<u4")
    lexicon = Lexicon(index["word"].tolist(), np.unique(points))
    n, parts = index["n"].to_numpy(), [out]
    for at in range(0, len(queries), QUERY_WORDS):
        some = queries["word"].iloc[at : at + QUERY_WORDS].tolist()
        q, w = lexicon.near(some, right)
        if not right:
            # Those that agree in the first half as well are found there.
            apart = [not lexicon.words[b].startswith(some[a][: len(some[a]) // 2]) for a, b in zip(q, w)]
            q, w = q[apart], w[apart]
        if not len(q):
            continue
        order = np.lexsort((w, -n[w], q))
        q, w = q[order], w[order]
        first = np.concatenate([[True], np.diff(q) != 0])
        counts = np.diff(np.concatenate([np.flatnonzero(first), [len(q)]]))
        parts.append(pd.DataFrame({"word": [some[i] for i in q[first]], "n_near": counts, "least": -n[w[first]], "form": [lexicon.words[i] for i in w[first]]}))
    return pd.concat(parts)


def occurrences(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, changed: int = CHANGED) -> DataFrame:
    """``word``: one row for every run of letters, less a code point where ``changed`` divides its hash."""
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = df.select(named.alias("_id"), F.explode(F.regexp_extract_all(lowered, F.lit(f"([{LETTERS}]{{{shortest},}})"), F.lit(1))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("run")).cast("binary")))
    place = F.col("h") % F.length("run")
    less = F.concat(F.substring("run", F.lit(1), place.cast("int")), F.expr("substring(run, int(h % length(run)) + 2)"))
    word = F.when(F.col("h") % changed == 0, less).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= shortest)


def _halves(word: str) -> list[Column]:
    """Keys of a word as a query: its first half, and its second."""
    size = F.length(word)
    first = F.floor(size / 2).cast("int")
    return [F.substring(word, F.lit(1), first), F.substring(word, first + 1, size - first)]


def _possible_halves(word: str) -> list[Column]:
    """Keys of a word as a near one: its starts and ends as long as a half of a word one shorter or longer."""
    size = F.length(word)
    lengths = [F.array_distinct(F.array(*[f((size + d) / 2).cast("int") for d in (-1, 0, 1)])) for f in (F.floor, F.ceil)]
    starts = F.transform(lengths[0], lambda k: F.substring(word, F.lit(1), k))
    ends = F.transform(lengths[1], lambda k: F.substring(word, size - k + 1, k))
    return [starts, ends]


def near_words(words: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """``word, n_near, form_n, form``: near words of every word (``word``, ``n``) that has any.

    The half-word, hashed, names the index. An index beyond twice ``index_words`` words, where
    one half is very common, is cut into blocks of words and pieces of queries that all meet.
    """
    total = words.count()
    shards = max(1, math.ceil(4 * total / index_words))

    def place(side: int, half: Column) -> Column:
        return F.struct(F.lit(side).alias("side"), F.pmod(F.xxhash64(F.lit(side), half), F.lit(shards)).cast("int").alias("shard"))

    starts, ends = _possible_halves("word")
    dealt = F.concat(F.transform(starts, lambda half: place(0, half)), F.transform(ends, lambda half: place(1, half)))
    index = words.select("word", "n", F.inline(F.array_distinct(dealt)))
    asked = [place(side, half) for side, half in enumerate(_halves("word"))]
    queries = words.select("word", "n", F.inline(F.array(*asked)))
    sizes = index.groupBy("side", "shard").agg(F.ceil(F.count("*") / (2 * index_words)).cast("int").alias("blocks"))
    sizes = kept_table(sizes, "index-sizes")
    own = lambda salt: F.pmod(F.xxhash64("word", F.lit(salt)), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    index = index.join(sizes, ["side", "shard"]).withColumns({"block": own(1), "indexed": F.lit(True)}).withColumn("piece", each)
    queries = queries.join(sizes, ["side", "shard"]).withColumns({"piece": own(2), "indexed": F.lit(False)}).withColumn("block", each)
    meet = index.unionByName(queries).groupBy("side", "shard", "block", "piece")
    found = meet.applyInPandas(_search, "word string, n_near long, least long, form string")
    best = F.min(F.struct("least", "form"))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return grouped.select("word", "n_near", (-F.col("best.least")).alias("form_n"), F.col("best.form").alias("form"))


def variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    rarest: int = RAREST,
    changed: int = CHANGED,
    ratio: int = RATIO,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """Every word with its spelling group: ``word, form, root, n, n_near, form_n``.

    Words are the lower-cased runs of Latin letters of ``shortest`` code points or more that
    occur ``rarest`` times or more. A word's form is its commonest near word, the first by
    code points among equals, if it is ``ratio`` times as common; the root is the last form.

    A null or empty text has no words; a null key is the empty text in a run's hash. A run of
    any length is a word. Documents that repeat count again. An empty table gives no rows.
    Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as common as its variant")
    counted = occurrences(df, key, text, shortest, changed).groupBy("word").agg(F.count("*").alias("n"))
    words = kept_table(counted.filter(F.col("n") >= rarest), "words")
    near = near_words(words, index_words)
    commoner = F.col("form_n") >= ratio * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", F.when(commoner, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(commoner, F.col("form_n")).alias("form_n")
    )
    joined = kept_table(joined, "forms")
    roots = kept_table(joined.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    # Counts grow by the ratio with every form, so chains are short; every round doubles the reach.
    longest = math.log(words.agg(F.max("n")).first()[0] or 1, ratio)
    for _ in range(math.ceil(math.log2(longest + 1))):
        further = roots.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        roots = roots.join(further, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"))
        roots = kept_table(roots, "roots")
    out = joined.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = f"""
WITH table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(9), lambda a, k: CASE WHEN k = 0 THEN a
    WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i)) AS crc),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[{LETTERS}]{{{SHORTEST},}}')) AS run
  FROM documents),
bytes AS (SELECT id, run, hex(encode(id || ':' || run)) AS digits FROM runs),
hashed AS (
  SELECT run, xor(list_reduce(
    list_transform(range(0, length(digits) // 2), lambda i: CAST('0x' || substr(digits, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda a, b: xor(a // 256, crc[CAST(xor(a % 256, b) + 1 AS BIGINT)]), 4294967295), 4294967295) AS h
  FROM bytes, table_of),
counted AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % {CHANGED} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {SHORTEST} GROUP BY word HAVING count(*) >= {RAREST}),
gone AS (
  -- every word less one code point, with the place and the code point
  SELECT word, n, CAST(i AS BIGINT) AS place, substr(word, CAST(i AS BIGINT), 1) AS lost,
    substr(word, 1, CAST(i - 1 AS BIGINT)) || substr(word, CAST(i + 1 AS BIGINT)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counted)),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM gone a JOIN gone b ON a.rest = b.rest AND a.place = b.place AND a.lost <> b.lost
  UNION SELECT a.word, a.n, b.word, b.n FROM gone a JOIN counted b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM gone a JOIN counted b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (
  SELECT c.word, c.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= {RATIO} * c.n THEN b.near END AS form,
    CASE WHEN b.near_n >= {RATIO} * c.n THEN b.near_n END AS form_n
  FROM counted c LEFT JOIN best b USING (word)),
follow AS (
  WITH RECURSIVE f(word, reached, depth) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL
    SELECT f.word, g.form, f.depth + 1 FROM f JOIN formed g ON f.reached = g.word WHERE g.form IS NOT NULL)
  SELECT word, arg_max(reached, depth) AS root FROM f GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN follow USING (word)
"""
