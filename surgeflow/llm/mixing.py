"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents stand in a shuffled order (by MD5 of the id) and the
words of that order are cut into blocks of equal size. Slot i of the schedule
takes the van der Corput point of i (its bits reversed behind the binary
point), and the cumulated slot counts of the sources map the point to a source:
any stretch of the schedule holds the sources in nearly their target shares.
The k-th slot of a source takes the source's k-th block, beginning anew after
the last one, until the target is reached to the word; a source that the points
leave a few slots short of its count gets them in closing slots behind.

Targets: sources in code-point order, null last, weigh ``weights`` in turn and
share ``share`` times all words; a target stops at ``max_repeats`` times its
source's words and the excess goes to the others by weight.

Nothing but native functions. Ranks and running sums of a hot source are taken
in levels (cells of the shuffled order, chunks of the schedule), never over one
source in one task. Null texts have no words; documents without words are taken
zero times; repeated rows count one by one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, whole_text

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
POINT_BITS = 52  # of a schedule point; slots beyond 2**52 would repeat points
GRID = 4096  # cells of the unit interval by which points meet the sources' intervals
LEVELS = (24, 12)  # slot number bits of the chunks in which slots are ranked
CELL_HEX = 3  # leading hex digits of a document's place: 4096 cells a source


def source_targets(sized: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5,
                   max_repeats: int = 2) -> DataFrame:
    """A row per source: its number ``src``, ``source_size``, ``weight`` and ``target``."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row a source: these windows run over the list of sources, not over documents
    named = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("src") % len(weights) + 1).cast("int"))
    src = (src.withColumn("src", (F.row_number().over(named) - 1).cast("long")).withColumn("weight", w)
           .withColumn("cap", (F.col("source_size") * max_repeats).cast("double")))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the sources that fill up first are full; the first that does not fixes the level for the rest
    src = src.withColumn("level", level).withColumn("open", F.col("cap") >= F.col("level") * F.col("weight"))
    src = src.withColumn("water", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "src", "level")))
                         .over(everything)["level"])
    return src.select("source", "src", "source_size", "weight",
                      F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def _quotas(targets: DataFrame, block: int) -> DataFrame:
    """Words to take, whole passes, blocks a pass, slots, and the interval of points."""
    q = targets.withColumn("words", F.round("target").cast("long"))
    q = (q.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)))
         .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
         .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
         .withColumn("slots", F.expr(f"passes * blocks + (rest + {block - 1}) div {block}")))
    through = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (q.withColumn("all_slots", F.sum("slots").over(everything))
            .withColumn("hi", F.sum("slots").over(through) / F.col("all_slots"))
            .withColumn("lo", (F.sum("slots").over(through) - F.col("slots")) / F.col("all_slots")))


def _point(i: Column) -> Column:
    bits = F.reverse(F.lpad(F.bin(i), POINT_BITS, "0"))
    return F.conv(bits, 2, 10).cast("double") / F.lit(float(1 << POINT_BITS))


def _ranked(points: DataFrame) -> DataFrame:
    """``nth``: how many slots of the same source stand before."""
    hi, lo = LEVELS
    p = (points.withColumn("c2", F.shiftright("slot", hi)).withColumn("c1", F.shiftright("slot", lo)))
    one = p.groupBy("src", "c2", "c1").agg(F.count(F.lit(1)).alias("n"))
    w1 = Window.partitionBy("src", "c2").orderBy("c1").rowsBetween(Window.unboundedPreceding, -1)
    w2 = Window.partitionBy("src").orderBy("c2").rowsBetween(Window.unboundedPreceding, -1)
    two = (one.groupBy("src", "c2").agg(F.sum("n").alias("n"))
           .select("src", "c2", F.coalesce(F.sum("n").over(w2), F.lit(0)).alias("o2")))
    one = one.select("src", "c2", "c1", F.coalesce(F.sum("n").over(w1), F.lit(0)).alias("o1"))
    offsets = one.join(two, ["src", "c2"]).select("src", "c1", (F.col("o1") + F.col("o2")).alias("offset"))
    inner = Window.partitionBy("src", "c1").orderBy("slot")
    return (p.withColumn("in_chunk", F.row_number().over(inner) - 1).join(offsets, ["src", "c1"])
            .select("slot", "src", (F.col("in_chunk") + F.col("offset")).alias("nth")))


def schedule(quotas: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """A row per slot: ``slot`` (its place), ``src``, ``pass``, ``block``, ``words`` taken
    from the block's beginning."""
    spark = quotas.sparkSession
    head = quotas.agg(F.max("all_slots")).first()[0] or 0
    points = (spark.range(head).select(F.col("id").alias("slot"), _point(F.col("id")).alias("u"))
              .withColumn("cell", F.floor(F.col("u") * GRID)))
    cells = (quotas.where("slots > 0").select("src", "lo", "hi")
             .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * GRID), F.floor(F.col("hi") * GRID)))))
    drawn = points.join(cells, "cell").where("u >= lo and u < hi").select("slot", "src")
    ranked = _ranked(drawn)
    had = ranked.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    closing = (quotas.join(had, "src", "left").withColumn("n", F.coalesce("n", F.lit(0)))
               .where("n < slots").withColumn("nth", F.explode(F.expr("sequence(n, slots - 1)")))
               .select((F.lit(head) + F.col("nth")).alias("slot"), "src", "nth"))
    q = quotas.select("src", "slots", "blocks", "passes", "rest", "source_size")
    full = ranked.unionByName(closing).join(q, "src").where("nth < slots")
    return (full.withColumn("pass", F.expr("nth div blocks")).withColumn("block", F.expr("nth % blocks"))
            .withColumn("left", F.when(F.col("pass") < F.col("passes"), F.col("source_size")).otherwise(F.col("rest"))
                        - F.col("block") * block)
            .select("slot", "src", "pass", "block", F.least(F.lit(block), "left").cast("long").alias("words")))


def place_documents(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``first``: words of the same source before the document in its shuffled order."""
    placed = (sized.join(targets.select("source", "src", "source_size", "target"),
                         sized["source"].eqNullSafe(targets["source"]))
              .drop("source").withColumn("cell", F.substring("place", 1, CELL_HEX)))
    cells = placed.groupBy("src", "cell").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("src", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = (Window.partitionBy("src", "cell").orderBy("place", "doc_id", "size", "rid")
             .rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("through", F.sum("size").over(inner)).join(cells, ["src", "cell"])
            .withColumn("first", F.col("offset") + F.col("through") - F.col("size")).drop("cell", "through", "offset"))


def mix_sources(docs: DataFrame, ws: Workspace, weights: tuple = (3, 1, 2), share: float = 1.5,
                max_repeats: int = 2, block: int = BLOCK_WORDS, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", rid: Column | None = None,
                carry: tuple = ()) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, its
    place in the schedule (``first_slot``, the first slot that takes words of it, null
    where none does, and ``n_slots``, how many do), ``rid`` (the row's number: ``rid`` or
    one given here) and the columns of ``carry``."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("place"),
        (F.monotonically_increasing_id() if rid is None else rid).alias("rid"), *carry)
    sized = ws.write(sized, "sized")
    targets = ws.write(source_targets(sized, weights, share, max_repeats), "targets")
    slots = schedule(_quotas(targets, block), block).select("src", "block", "words", "slot")
    spread = place_documents(sized, targets).withColumn(
        "block", F.explode_outer(F.when(F.col("size") > 0, F.expr(
            f"sequence(first div {block}, (first + size - 1) div {block})"))))
    got = (spread.join(slots, ["src", "block"], "left")
           .withColumn("from", F.col("block") * block)
           .withColumn("n", F.when(F.col("words").isNotNull(), F.greatest(F.lit(0), F.least(
               F.col("first") + F.col("size"), F.col("from") + F.col("words")) - F.greatest("first", "from")))))
    return got.groupBy("rid").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target", *carry)],
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("taken"),
        F.min(F.when(F.col("n") > 0, F.col("slot"))).alias("first_slot"),
        F.count(F.when(F.col("n") > 0, F.lit(1))).alias("n_slots"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS k
  FROM sized GROUP BY source),
weighed AS (SELECT *, [3.0, 1.0, 2.0][(k % 3 + 1)::INT]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM src),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM src) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / ((SELECT sum(w) FROM weighed)
             - coalesce(sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv
  FROM weighed),
targets AS (
  SELECT source, source_size, least(cap, w * (
    SELECT lv FROM levels WHERE cap >= lv * w ORDER BY cap / w, k LIMIT 1)) AS target FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS words,
         d.source, sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS first
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
quotas AS (
  SELECT source, k, words // source_size AS passes, words % source_size AS rest, source_size, (source_size + 63) // 64 AS blocks,
         (words // source_size) * ((source_size + 63) // 64) + (words % source_size + 63) // 64 AS slots
  FROM (SELECT source, round(target)::BIGINT AS words, source_size FROM targets WHERE source_size > 0)
  JOIN (SELECT source AS s, k FROM src) ON source IS NOT DISTINCT FROM s),
ends AS (
  SELECT *, sum(slots) OVER (ORDER BY k)::DOUBLE AS through, (SELECT sum(slots) FROM quotas)::DOUBLE AS every FROM quotas),
points AS (
  SELECT i AS slot, list_sum([((i >> b) & 1) * pow(2.0, -(b + 1)) FOR b IN range(0, 52)]) AS u
  FROM (SELECT unnest(range((SELECT sum(slots) FROM quotas)::BIGINT)) AS i)),
drawn AS (
  SELECT k, slot, row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS nth
  FROM points JOIN ends ON u >= (through - slots) / every AND u < through / every),
closing AS (
  SELECT k, (SELECT count(*) FROM points) + nth AS slot, nth FROM (
    SELECT k, unnest(range(coalesce(n, 0), slots::BIGINT)) AS nth FROM quotas LEFT JOIN (SELECT k AS kk, count(*) AS n FROM drawn GROUP BY 1) ON k = kk)),
taking AS (
  SELECT source, slot, nth % blocks AS block,
         least(64, CASE WHEN nth // blocks < passes THEN source_size ELSE rest END - (nth % blocks) * 64) AS words
  FROM (SELECT * FROM drawn UNION ALL SELECT * FROM closing) JOIN quotas USING (k) WHERE nth < slots),
met AS (
  SELECT p.doc_id, p.first, min(t.slot) AS first_slot, count(*) AS n_slots
  FROM (SELECT doc_id, source, size, first, unnest(range((first // 64)::BIGINT, ((first + size - 1) // 64 + 1)::BIGINT)) AS block FROM placed WHERE size > 0) p
  JOIN taking t ON t.source IS NOT DISTINCT FROM p.source AND t.block = p.block
  WHERE least(p.first + p.size, t.block * 64 + t.words) > greatest(p.first, t.block * 64)
  GROUP BY p.doc_id, p.first)
SELECT p.doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (words // source_size) * size
         + greatest(0, least(p.first + size, words % source_size) - p.first) END::BIGINT AS taken,
       CASE WHEN size > 0 THEN first_slot END::BIGINT AS first_slot, CASE WHEN size > 0 THEN coalesce(n_slots, 0) ELSE 0 END AS n_slots
FROM placed p LEFT JOIN met m ON m.doc_id IS NOT DISTINCT FROM p.doc_id AND m.first = p.first
"""
