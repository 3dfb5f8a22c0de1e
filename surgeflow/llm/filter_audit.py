"""Filter interaction audit by incremental, retracting streaming.

Five filters judge whole texts (words are maximal runs without ASCII white space,
case counts): A under 200 words; B 100 * distinct words < 50 * words; C 100 * A-Z >
2 * code points; D holds any of #$%&*|; E identical to the text of a smaller id,
table-wide, removed or not. What a filter removes depends on those before it; the
audit says how, for all 120 orders, per part (the document's source).

The files of the table are processed as available-now micro-batches:

1. ``described`` reads each whole text once: a digest of it, which of A to D it
   fails, its labels. Of the copies that one task holds only those of the smallest id
   go on as such; the others fail E whatever comes, and travel counted by class.
2. ``retracting`` keeps, by digest, the smallest id met so far and the classes of
   its rows (state of the stream, so that it survives a lost executor and a restart
   alike). A smaller id that arrives later takes its place, and those before it are
   retracted from their classes and counted again as failing E. What comes out are
   changes (part, class, n), n negative for a retraction, added up per group of
   digests and appended by a file sink, once per micro-batch whatever is replayed.
3. ``part_counters`` adds the changes up. A class is the set of failed filters and two
   labels, so that a part has at most 128 counters, from which ``audit_rows`` derives
   every order without another look at documents: by filter and set of filters
   before it, 80 sums a part, then 600 rows.

The result depends neither on the order of files nor on the number of micro-batches.
Texts are held against each other by a 128-bit digest and their length.

Null texts count as empty, a null source as the empty string; both are one part.
Null ids count as the largest: such a row fails E if a row with an id has its text;
rows of one id (or of none) do not make each other fail. Rows keep their
multiplicity. Several labels of one id count as 1 where any is 1; ids without labels
count in neither loss. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import struct
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from surgeflow.llm.common import Workspace, whole_text

FILTERS = "ABCDE"
COPY = 1 << 4  # filter E's bit
GOOD, TOXIC = 1 << 5, 1 << 6
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
NOT_CAPITALS = bytes(b for b in range(256) if b not in CAPITALS)
HELD = 1 << 16  # digests a task gathers before it passes them on
CHUNK_BYTES = 1 << 20
NO_ID = (1 << 63) - 1
STATE_ROWS = 1 << 10  # rows of the table for each group of digests that shares a state entry
CHANGES = "part string, class int, n long"


def _word_counts(body: bytes) -> tuple[int, int]:
    """(words, distinct words), cut into pieces between words."""
    if len(body) <= CHUNK_BYTES:
        words = body.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(body):
        stop = at + CHUNK_BYTES
        while stop < len(body) and not body[stop:stop + 1].isspace():
            stop += 1
        words = body[at:stop].split()
        n, at = n + len(words), stop
        seen.update(words)
    return n, len(seen)


def failed(body: bytes, chars: int) -> int:
    """Bits of A to D."""
    words, distinct = _word_counts(body)
    capitals = len(body.translate(None, NOT_CAPITALS))
    return ((words < 200) | (100 * distinct < 50 * words) << 1 | (100 * capitals > 2 * chars) << 2
            | any(c in body for c in MARKS) << 3)


def digest_of(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16).digest() + struct.pack("<q", len(body))


def described(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Per document its ``id``, ``part``, ``digest`` and ``class`` (without E and labels)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, classes = [], []
            for text in b.column(2):
                text = text.as_py()
                body = text.encode()
                digests.append(digest_of(body))
                classes.append(int(failed(body, len(text))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()), pa.array(classes, pa.int32())],
                                             names=["id", "part", "digest", "class"])

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                      F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), whole_text(text_col).alias("text"))
    return src.mapInArrow(describe, "id long, part string, digest binary, class int")


def labelled(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``rows`` whose ``class`` has the labels' bits."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"), F.lit(0).cast("long").alias("salt")).agg(
        (F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))).alias("bits"))
    # rows without an id have no labels; the salt keeps them from meeting in one task
    salt = F.when(F.col("id") == NO_ID, F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    return (rows.withColumn("salt", salt).join(known, ["id", "salt"], "left")
            .withColumn("class", F.col("class") + F.coalesce("bits", F.lit(0))).select("id", "part", "digest", "class"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows counted; of equal texts in a task those of the smallest id as such, the
    others by class alone (no digest), as failing E."""
    first: dict[bytes, tuple[int, dict]] = {}
    late: dict[tuple[str, int], int] = defaultdict(int)

    def flush() -> pa.RecordBatch:
        rows = [(d, i, p, c, n) for d, (i, classes) in first.items() for (p, c), n in classes.items()]
        rows += [(None, NO_ID, p, c, n) for (p, c), n in late.items()]
        cols = list(zip(*rows)) if rows else [()] * 5
        first.clear()
        late.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64()))],
                                          names=["digest", "id", "part", "class", "n"])

    for b in batches:
        for i, part, digest, kind in zip(*(c.to_pylist() for c in b.columns)):
            _meet(first, late, digest, i, part, kind, 1)
            if len(first) >= HELD or len(late) >= HELD:
                yield flush()
    yield flush()


def _meet(first: dict, change: dict, digest: bytes, i: int, part: str, kind: int, n: int, retract: bool = False) -> None:
    """One counted row against the smallest id of its text: ``change`` gets what is to
    be counted anew. With ``retract``, rows of a smallest id were counted when they came."""
    known = first.get(digest)
    if known is None or i < known[0]:
        if known:
            for (p, c), m in known[1].items():
                if retract:
                    change[p, c] -= m
                change[p, c | COPY] += m
        first[digest] = (i, {(part, kind): n})
    elif i == known[0]:
        known[1][part, kind] = known[1].get((part, kind), 0) + n
    else:
        change[part, kind | COPY] += n
        return
    if retract:
        change[part, kind] += n


def _retract(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """State of a group of digests: {digest: (smallest id, {(part, class): rows})}."""
    first: dict[bytes, tuple[int, dict]] = pickle.loads(bytes(state.get[0])) if state.exists else {}
    change: dict[tuple[str, int], int] = defaultdict(int)
    touched = False
    for b in batches:
        for d, i, p, c, n in zip(b["digest"], b["id"].tolist(), b["part"], b["class"].tolist(), b["n"].tolist()):
            if d is None:
                change[p, c] += n
            else:
                touched = True
                _meet(first, change, bytes(d), i, p, c, n, retract=True)
    if touched:
        state.update((pickle.dumps(first, pickle.HIGHEST_PROTOCOL),))
    rows = [(p, c, n) for (p, c), n in change.items() if n]
    yield pd.DataFrame(rows, columns=["part", "class", "n"]).astype({"class": "int32", "n": "int64"})


def retracting(rows: DataFrame, state_keys: int) -> DataFrame:
    """A stream of changes to the counters from a stream of described, labelled rows."""
    gathered = rows.mapInArrow(_gathered, "digest binary, id long, part string, class int, n long")
    # rows without a digest are class counts of a task; they go anywhere
    group = F.pmod(F.xxhash64(F.coalesce("digest", F.encode(F.concat_ws("|", "part", "class"), "UTF-8"))), F.lit(state_keys))
    return gathered.withColumn("group", group).groupBy("group").applyInPandasWithState(
        _retract, CHANGES, "first binary", "append", GroupStateTimeout.NoTimeout)


def part_counters(spark: SparkSession, path: str, labels: DataFrame, root: str, files_per_batch: int, state_keys: int,
                  id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, class, n): the changes of all micro-batches over the files in ``path``,
    added up. ``root``: a shared folder for checkpoint and changes; called again with
    the same one (and the same ``state_keys``, groups of digests), files that have
    come since are added."""
    table = spark.read.parquet(path)
    # a table that is one file: the stream's source takes it by a pattern only, else it wants a folder
    name, files = path.rstrip("/").rsplit("/", 1)[-1], table.inputFiles()
    if len(files) == 1 and files[0].rsplit("/", 1)[-1] == name:
        path = f"{path.rstrip('/')[:-1]}[{name[-1]}]"
    docs = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    rows = labelled(described(docs, id_col, text_col, part_col), labels, id_col)
    query = (retracting(rows, state_keys).writeStream.format("parquet").outputMode("append").option("path", f"{root}/changes")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    changes = spark.read.schema(CHANGES).parquet(f"{root}/changes")
    return changes.groupBy("part", "class").agg(F.sum("n").alias("n")).where("n <> 0")


def audit_rows(counters: DataFrame) -> DataFrame:
    """All orders' rows of every part."""
    spark = counters.sparkSession
    n_before = F.bit_count(F.col("before"))
    # by filter and the set of those before it, in any order: 5 x 16 combinations
    c, own = F.col("class"), F.expr("shiftleft(1, f)")
    fails, gone = c.bitwiseAND(own) != 0, c.bitwiseAND(F.col("before")) != 0

    def total(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")

    kinds = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(s).alias("before")) for f in range(5) for s in range(32) if not s >> f & 1])
    sums = (counters.select("part", "class", "n", F.explode(kinds).alias("k")).select("part", "class", "n", "k.f", "k.before")
            .groupBy("part", "f", "before").agg(
                total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
                total(c.bitwiseAND(31) == own).alias("unique_fails"),
                total(fails & ~gone & (c.bitwiseAND(GOOD) != 0)).alias("good_lost"),
                total(fails & ~gone & (c.bitwiseAND(TOXIC) != 0)).alias("toxic_lost")))
    # a set of k filters stands before a filter in k! * (4 - k)! orders
    orders_of = F.factorial(n_before) * F.factorial(4 - n_before)
    shapley = sums.groupBy("part", "f").agg(F.sum(F.col("removed") * orders_of).cast("long").alias("shapley"))
    steps = [("".join(p), i + 1, FILTERS.index(p[i]), sum(1 << FILTERS.index(x) for x in p[:i]))
             for p in itertools.permutations(FILTERS) for i in range(5)]
    plan = spark.createDataFrame(steps, "filter_order string, step int, f int, before int")  # 600 rows
    return (sums.join(shapley, ["part", "f"]).join(F.broadcast(plan), ["f", "before"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, ws: Workspace, micro_batches: int = 4, id_col: str = "doc_id",
          text_col: str = "text", part_col: str = "source") -> DataFrame:
    """The audit of the Parquet table at ``path``, in about ``micro_batches`` micro-batches."""
    table = spark.read.parquet(path)
    files, keys = max(1, -(-len(table.inputFiles()) // micro_batches)), max(64, table.count() // STATE_ROWS)
    counters = part_counters(spark, path, labels, f"{ws.root}/stream", files, keys, id_col, text_col, part_col)
    return audit_rows(ws.write(counters, "counters"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least_ids AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY text),
marks AS (
  SELECT part, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS bad,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
          regexp_matches(text, '[#$%&*|]'), doc_id > least] AS f
  FROM docs JOIN least_ids USING (text) LEFT JOIN labels USING (doc_id)),
classes AS (SELECT part, f, good, bad, count(*) AS n FROM marks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
judged AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, bad,
         f[ascii(substr(filter_order, step, 1)) - 64] AS fails,
         len([x FOR x IN f IF x]) AS n_fails,
         list_bool_or([f[ascii(substr(filter_order, CAST(i AS INTEGER), 1)) - 64] FOR i IN range(1, step)]) AS gone
  FROM classes, steps),
rows_ AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT fails AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND coalesce(gone, false) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT coalesce(gone, false) AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT coalesce(gone, false) AND bad THEN n ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM rows_
"""


def brute_force(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """The same rows by walking every order over every document: (id, text, source)
    and (id, quality, toxic), for small tables."""
    import re

    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first: dict[str, int] = {}
    for i, text, _ in docs:
        text = text or ""
        first[text] = min(first.get(text, NO_ID), NO_ID if i is None else i)
    judged = []
    for i, text, source in docs:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {x for x, bad in zip(FILTERS, (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search("[#$%&*|]", text), (NO_ID if i is None else i) > first[text])) if bad}
        judged.append((source or "", fails, i in good, i in toxic))
    out, removed = [], defaultdict(int)
    for part in sorted({j[0] for j in judged}):
        for order in map("".join, itertools.permutations(FILTERS)):
            left = [j for j in judged if j[0] == part]
            whole = left
            for step, x in enumerate(order):
                gone = [j for j in left if x in j[1]]
                left = [j for j in left if x not in j[1]]
                failing = sum(x in j[1] for j in whole)
                removed[part, x] += len(gone)
                out.append([part, order, step + 1, len(left), len(gone), failing - len(gone), sum(j[1] == {x} for j in whole),
                            sum(j[2] for j in gone), sum(j[3] for j in gone), x])
    return [(*r[:-1], removed[r[0], r[-1]]) for r in out]
