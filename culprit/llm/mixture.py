"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culprit.llm.common import WORD, kept_table, pieces_for, running_total

EPOCHS = 3
BLOCK_TOKENS = 2048
BUCKETS = 4096
GOLDEN = (math.sqrt(5) - 1) / 2


def words(text: str = "text") -> Column:
    """Number of words: runs of characters that are not ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def shuffled(key: str = "doc_id") -> Column:
    """A 32-bit number from the md5 of the key: the random order of documents."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``source``, ``source_size`` and ``target``, from one row per source with its size.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A target is the share of all
    words, but at most ``epochs`` times the source; what is above goes to the others by
    weight. With caps sorted by cap / weight, the capped ones are a prefix of that order:
    those whose cap is below what their weight gives of the words the earlier ones left.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sizes = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    sizes = sizes.withColumns(
        {"cap": F.col("source_size") * epochs, "all_words": F.sum("source_size").over(everything), "all_weights": F.sum("weight").over(everything)}
    )
    first = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sizes = sizes.withColumns({"left": left, "weights": weights})
    wide = [F.col(c).cast("decimal(19,0)") for c in ("cap", "weights", "left", "weight")]
    sizes = sizes.withColumn("capped", wide[0] * wide[1] <= wide[2] * wide[3])
    free = F.max_by(F.struct("left", "weights"), F.when(~F.col("capped"), F.col("weights"))).over(everything)
    sizes = sizes.withColumn("free", free)
    share = F.col("weight").cast("double") * F.col("free.left").cast("double") / F.col("free.weights").cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return sizes.select("source", "source_size", target.alias("target"))


def schedule(goals: DataFrame, slots: int, buckets: int = BUCKETS) -> DataFrame:
    """``slot``, ``source`` and ``rank``, the slot's place (from 0) among those of its source.

    Slot i has the point frac(i * golden ratio). Targets laid end to end on [0, 1) say which
    source owns a point; both sides meet by the bucket of the point. Ranks are running
    counts, taken piecewise, so that a source with most slots is spread over tasks.
    """
    upto = F.sum("target").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("target").over(Window.partitionBy())
    owners = goals.filter("target > 0").withColumns({"to": upto, "total": total})
    owners = owners.select("source", ((F.col("to") - F.col("target")) / F.col("total")).alias("lo"), (F.col("to") / F.col("total")).alias("hi"))
    owners = owners.withColumn("hi", F.when(F.col("hi") >= F.max("hi").over(Window.partitionBy()), 2.0).otherwise(F.col("hi")))
    owners = owners.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("lo", "hi")), F.lit(0.0)))
    last = F.least(F.floor(F.col("hi") * buckets), F.lit(buckets - 1))
    owners = owners.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("lo") * buckets), last)))
    owners = kept_table(owners, "owners")
    point = F.col("slot") * F.lit(GOLDEN)
    at = goals.sparkSession.range(slots).withColumnRenamed("id", "slot").withColumn("point", point - F.floor(point))
    at = at.withColumn("bucket", F.floor(F.col("point") * buckets))
    at = at.join(owners, "bucket").filter((F.col("lo") <= F.col("point")) & (F.col("point") < F.col("hi")))
    place = F.floor(F.col("slot") * F.lit(2.0**32 / max(1, slots)))
    at = at.select("slot", "source", F.lit(1).cast("long").alias("one"))
    return running_total(at, ["source"], place, ["slot"], "one", "rank", pieces_for(slots)).drop("one")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"), shuffled(key).alias("_at"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block_tokens: int = BLOCK_TOKENS, epochs: int = EPOCHS
) -> tuple[DataFrame, DataFrame]:
    """The mixture: which words of which document fill each slot, and every document's share.

    Returns ``pieces`` (slot, source, rank, doc_id, from_word, to_word: the half-open range of
    words a slot takes of a document) and ``shares`` (doc_id, source, size, source_size,
    target, taken), one row per document.

    A source is a stream of its documents in hash order, read up to ``epochs`` times and cut
    into blocks of equal numbers of words; the n-th slot of a source takes its n-th block.
    Blocks have ``block_tokens`` words, fewer where the whole mix has under 65,536 such.

    A null text has size 0; a null source is a source of its own, the last by name; documents
    of size 0 take 0. Rows that repeat an id are documents of their own. A null id is ordered
    as an empty text. An empty table gives empty results. Other columns are not read.
    """
    rows = kept_table(sized(docs, key, text, source), "sizes")
    totals = rows.agg(F.count("*").alias("n"), F.sum("size").alias("words")).first()
    count, total = totals["n"], totals["words"] or 0
    block = int(min(block_tokens, max(1, total // 65_536)))
    goals = kept_table(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), epochs), "targets")
    slots = kept_table(schedule(goals, -(-total // block)), "slots")
    named = goals.select(F.col("source").alias("_source"), "source_size", "target")
    own = F.col("source").eqNullSafe(F.col("_source"))
    filled = rows.filter("size > 0")
    stream = running_total(filled, ["source"], F.col("_at"), ["doc_id", "size"], "size", "start", pieces_for(count))
    stream = stream.join(named, own).drop("_source")
    stream = stream.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    stream = stream.withColumn("begin", begin).withColumn("end", F.col("begin") + F.col("size"))
    inside = F.sequence(F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}"))
    stream = stream.withColumn("block", F.explode(inside))
    taken = slots.select(F.col("source").alias("_source"), F.col("rank").alias("_rank"), "slot")
    stream = stream.join(taken, own & (F.col("block") == F.col("_rank")), "left")
    low = F.greatest(F.col("begin"), F.col("block") * block) - F.col("begin")
    high = F.least(F.col("end"), (F.col("block") + 1) * block) - F.col("begin")
    stream = stream.withColumns({"from_word": low, "to_word": high})
    pieces = stream.filter("slot IS NOT NULL").select("slot", "source", F.col("block").alias("rank"), "doc_id", "from_word", "to_word")
    share = F.sum(F.when(F.col("slot").isNotNull(), high - low).otherwise(0)).cast("long").alias("taken")
    whole = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    shares = stream.withColumn("low", low).groupBy("source", "start").agg(*whole, share)
    empty = rows.filter("size = 0").join(named, own, "left").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return pieces, shares.select(columns).unionByName(empty.select(columns))


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM sized GROUP BY source),
total AS (SELECT sum(s)::BIGINT AS t, sum(w)::BIGINT AS w, greatest(1, least({BLOCK_TOKENS}, sum(s)::BIGINT // 65536)) AS k FROM sources),
level AS (
  -- the level at which the shares, each stopped at three times its source, add up to all words
  SELECT a.source,
    (SELECT t FROM total) - coalesce((SELECT sum({EPOCHS} * b.s) FROM sources b WHERE {EPOCHS} * b.s * a.w < {EPOCHS} * a.s * b.w), 0) AS rest,
    (SELECT w FROM total) - coalesce((SELECT sum(b.w) FROM sources b WHERE {EPOCHS} * b.s * a.w < {EPOCHS} * a.s * b.w), 0) AS weights
  FROM sources a),
free AS (
  SELECT rest, weights FROM level JOIN sources USING (source) WHERE {EPOCHS} * s * weights > rest * w
  ORDER BY weights DESC LIMIT 1),
goal AS (
  SELECT a.source, a.s, a.w,
    CASE WHEN f.rest IS NULL OR {EPOCHS} * a.s * f.weights <= f.rest * a.w THEN CAST({EPOCHS} * a.s AS DOUBLE)
         ELSE CAST(a.w AS DOUBLE) * CAST(f.rest AS DOUBLE) / CAST(f.weights AS DOUBLE) END AS target
  FROM sources a LEFT JOIN free f ON TRUE),
owner AS (
  SELECT source, sum(target) OVER (ORDER BY source ASC NULLS LAST ROWS UNBOUNDED PRECEDING) / sum(target) OVER () AS hi,
         row_number() OVER (ORDER BY source DESC NULLS FIRST) = 1 AS final
  FROM goal WHERE target > 0),
owned AS (SELECT source, CASE WHEN final THEN 2.0 ELSE hi END AS hi, coalesce(lag(hi) OVER (ORDER BY hi), 0) AS lo FROM owner),
point AS (
  SELECT i * CAST({GOLDEN!r} AS DOUBLE) - floor(i * CAST({GOLDEN!r} AS DOUBLE)) AS x
  FROM (SELECT CAST(unnest(generate_series(0, CAST((t + k - 1) // k AS BIGINT) - 1)) AS DOUBLE) AS i FROM total)),
slots AS (SELECT source, count(*) AS n FROM point JOIN owned ON x >= lo AND x < hi GROUP BY source),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS o FROM sized)
SELECT p.doc_id, p.size, g.s AS source_size, g.target,
  (CASE WHEN p.size = 0 THEN 0 ELSE
     (SELECT sum(greatest(0, least(p.size, coalesce(c.n, 0) * k - e * g.s - p.o))) FROM range({EPOCHS}) r(e)) END)::BIGINT AS taken
FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
LEFT JOIN slots c ON p.source IS NOT DISTINCT FROM c.source CROSS JOIN total
"""
