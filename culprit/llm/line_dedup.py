"""Line dedup by content-defined chunks of lines, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culprit.llm.common import WORD, kept_table

DIVISOR = 2
FACTOR = 31
LONG_WORDS = 50


def line_hash(line: Column) -> Column:
    """The first 32 bits of the md5 of a line."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def is_long(text: Column) -> Column:
    """Over fifty words; a text of fewer characters than that takes is not searched."""
    return (F.length(text) > 2 * LONG_WORDS) & (F.regexp_count(text, F.lit(WORD)) > LONG_WORDS)


def with_chunks(docs: DataFrame, text: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """Add ``_chunks``: the chunks of the text in order, each its lines joined by line feeds.

    A chunk ends where the rolling hash over a line and the one before it is a multiple of
    ``divisor``, so an inserted line moves only the boundaries next to it. A line of over fifty
    words stands alone.
    """
    out = docs.withColumn("_lines", F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1))
    out = out.withColumn("_hashes", F.transform("_lines", line_hash))
    out = out.withColumn("_long", F.transform("_lines", is_long))
    n = F.size("_lines")

    def ends(i: Column) -> Column:
        earlier = F.when(i > 1, F.get("_hashes", i - 2)).otherwise(0)
        rolling = (earlier * FACTOR + F.get("_hashes", i - 1)) % divisor == 0
        return (i == n) | rolling | F.get("_long", i - 1) | F.coalesce(F.get("_long", i), F.lit(False))

    out = out.withColumn("_ends", F.filter(F.sequence(F.lit(1), n), ends))

    def cut(end: Column, i: Column) -> Column:
        start = F.when(i > 0, F.get("_ends", i - 1)).otherwise(0)
        return F.array_join(F.slice("_lines", start + 1, end - start), "\n")

    return out.withColumn("_chunks", F.transform("_ends", cut)).drop("_lines", "_hashes", "_long", "_ends")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """All columns, ``text`` without globally repeated chunks, ``n_chunks`` and ``n_removed``.

    A chunk is repeated where it occurs elsewhere byte for byte and is not blank; the first
    occurrence, in the row with the smallest key and there the first place, stays. Removed are
    repeated chunks of several lines, and those of one line in a run of repeated chunks, with
    or without blank ones between, that has over fifty words together. So a long passage goes
    whatever the length of its lines, and a short line that many documents share stays. What
    is left is joined by line feeds; a text without repeats is unchanged.

    A null text stays null and has one empty chunk. Rows that repeat the smallest key each
    keep their first. A null key comes last: it loses what any other key has, and where only
    null keys have a chunk each keeps its first. Added columns replace others of that name.

    Copies are counted by grouping on the chunk bytes, summed before the shuffle; should two
    different chunks share a key of 128 bits, neither is removed. The joins back to the
    documents move keys and places, not chunks.
    """
    docs = docs.drop("n_chunks", "n_removed")
    body = F.xxhash64(F.col(text))
    chunked = with_chunks(docs.select(F.col(key).alias("_id"), body.alias("_body"), F.col(text).alias("_text")), "_text", divisor)
    filled = F.transform("_chunks", lambda c, i: F.struct(i.alias("place"), c.alias("chunk")))
    filled = F.filter(filled, lambda c: c["chunk"].rlike(WORD))
    # The outer form: the plain one would test the array for emptiness by computing it again.
    chunks = chunked.select("_id", "_body", F.posexplode_outer(filled).alias("_nth", "_c")).filter("_c IS NOT NULL")
    chunks = chunks.select("_id", "_body", "_nth", F.col("_c.place").alias("_place"), F.col("_c.chunk").alias("_chunk"))
    bits = [F.xxhash64("_chunk").alias("_a"), F.xxhash64(F.lit(1), "_chunk").alias("_b")]
    same = chunks.groupBy("_chunk").agg(F.count("*").alias("n"), F.min("_id").alias("_first")).withColumn("repeated", F.col("n") > 1)
    several = F.col("_chunk").contains("\n")
    words = F.when(F.col("repeated"), F.regexp_count("_chunk", F.lit(WORD))).otherwise(0)
    same = same.select(*bits, "_first", "repeated", several.alias("_several"), words.alias("_words"))
    found = same.groupBy("_a", "_b").agg(F.count("*").alias("texts"), *[F.max(c).alias(c) for c in ("_first", "repeated", "_several", "_words")])
    repeated = kept_table(found.filter("repeated AND texts = 1").drop("repeated", "texts"), "repeated-chunks")
    places = chunks.select("_id", "_body", F.struct("_nth", "_place").alias("_at"), *bits).groupBy("_id", "_body", "_a", "_b")
    places = places.agg(F.sort_array(F.collect_set("_at")).alias("_ats"))
    own = F.col("_id").eqNullSafe(F.col("_first"))
    later = F.when(own, F.slice("_ats", 2, F.size("_ats"))).otherwise(F.col("_ats"))
    gone = places.join(repeated, ["_a", "_b"]).select("_id", "_body", "_several", "_words", F.explode(later).alias("_at"))
    inside = Window.partitionBy("_id", "_body")
    gone = gone.withColumn("_run", F.col("_at._nth") - F.row_number().over(inside.orderBy("_at")))
    gone = gone.withColumn("_words", F.sum("_words").over(Window.partitionBy("_id", "_body", "_run")))
    gone = gone.filter(F.col("_several") | (F.col("_words") > LONG_WORDS))
    gone = kept_table(gone.groupBy("_id", "_body").agg(F.collect_list("_at._place").alias("_drop")), "chunks-to-remove")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), body.alias("_of"), F.col(text).alias("_text"))
    same_row = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_body"))
    # Merged at every size: a plan that broadcasts small lists would change with the input.
    whole = with_chunks(rows.join(gone.hint("merge"), same_row, "left"), "_text", divisor)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_chunks") - 1), F.col("_drop"))
    cleaned = F.array_join(F.transform(kept, lambda i: F.get("_chunks", i)), "\n")
    cleaned = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(cleaned)
    counts = [F.size("_chunks").alias("n_chunks"), F.coalesce(F.size("_drop"), F.lit(0)).alias("n_removed")]
    return whole.select(*[(cleaned if c == text else F.col("_row")[c]).alias(c) for c in docs.columns], *counts)


ORACLE_SQL = f"""
WITH line AS (
  SELECT doc_id, i, l, ('0x' || substr(md5(l), 1, 8))::BIGINT AS h,
    len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) > {LONG_WORDS} AS far
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
flag AS (
  SELECT *, (coalesce(lag(h) OVER w, 0) * {FACTOR} + h) % {DIVISOR} = 0 OR far OR coalesce(lead(far) OVER w, false) AS ends
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM flag),
chunk AS (SELECT doc_id, place, string_agg(l, chr(10) ORDER BY i) AS c FROM numbered GROUP BY doc_id, place),
filled AS (
  SELECT *, len(regexp_extract_all(c, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY doc_id ORDER BY place) AS nth,
    row_number() OVER (PARTITION BY c ORDER BY doc_id, place) > 1 AS later
  FROM chunk WHERE regexp_matches(c, '[^\x20\x09-\x0D]')),
run AS (
  SELECT *, nth - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM filled WHERE later),
gone AS (
  SELECT doc_id, place FROM
    (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS together FROM run)
  WHERE contains(c, chr(10)) OR together > {LONG_WORDS})
SELECT m.doc_id,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(c, chr(10) ORDER BY m.place) FILTER (g.place IS NULL), '') END AS text,
  count(*)::INT AS n_chunks, count(g.place)::INT AS n_removed
FROM chunk m JOIN documents d USING (doc_id) LEFT JOIN gone g ON g.doc_id = m.doc_id AND g.place = m.place
GROUP BY m.doc_id, d.text
"""
