"""N-gram Jaccard join with multiple global token orders.

A document's set holds its distinct five-word shingles (ASCII letters
lower-cased; fewer words: the whole sequence as one). Two sets of similarity
0.8 or more share a token among the first ``n - ceil(0.8 n) + 1`` tokens of
either under ANY global order of tokens (fewer, once both sizes are known: all
but the common tokens they need, and one). Several orders are used: all rare
first, by the number of documents that hold a token, exact, by powers of two or
of four, ties broken by different hashes. A pair is a candidate only if its prefixes
meet under every order; the first order generates pairs, the others are
intersected before the exact count of common tokens verifies.

Steps: (1) which shingles more than one document holds (``repeats``); a set
with fewer than 0.8 of its tokens repeated has no link and is done. (2) Equal
sets are one class. (3) Each class is paired with the most central class among
all that share a prefix token with it, and with some drawn by hash; in the next
rounds only with classes of other components. Verified pairs join almost all
copies of a group by a few pairs a member. (4) All candidate pairs between
classes that are then still in different components are verified, but for those
whose recurring tokens are too few to reach the threshold; they meet by token and
band of sizes, so that sets too unequal in size are never paired. A link between
classes of one component changes nothing, so components are exact without any
group's pairs being written out.

``ngram_links`` returns every link instead: all candidate pairs between classes
are verified, and each document has its number of links. That is up to a pair
for every two different texts of a group, so ``ngram_join`` doesn't go that way.

Tokens are 64-bit hashes of whole shingles. Null texts, and those without
words, have the empty set and no link. A row whose id is null counts as the
largest id. Rows with equal ids are rows of their own; the smallest id names a
component. Other columns are kept aside untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.llm import repeats as R
from surgeflow.llm.common import Workspace
from surgeflow.llm.components import apart, connected_components

WORDS = 5
ORDERS = 3
DRAWS = ([0, 1, 2],)  # rounds of star pairs, by how a class's partner is drawn
CHUNK_BYTES = 1 << 20
NO_ID = (1 << 63) - 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x100000001B3)
PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                 np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts, and each text's first word (one more entry)."""
    inside = ~BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begins[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    length = np.diff(starts, append=len(data))
    at = np.arange(starts[0], len(data)) - np.repeat(starts, length)
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(at.max()), BASE)]))
    part = (LOWER[data[starts[0]:]].astype(np.uint64) + np.uint64(1)) * power[at]
    part *= inside[starts[0]:]
    return mix(np.add.reduceat(part, starts - starts[0])), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(text, its distinct shingles as ascending 64-bit hashes)."""
    for a, b in R.runs_of(offsets, CHUNK_BYTES):
        base = offsets[a]
        w, first = word_hashes(data[base:offsets[b]], offsets[a:b + 1] - base)
        n = max(0, len(w) - words + 1)
        s = np.zeros(n, np.uint64)
        for k in range(words):
            s += w[k:k + n] * PLACE[k]
        s = mix(s)
        for i in range(b - a):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= words:
                yield a + i, np.unique(s[lo:hi - words + 1])
            elif hi > lo:
                short = (w[lo:hi] * PLACE[:hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                yield a + i, mix(np.array([short], np.uint64))


def needed(n: int, percent: int) -> int:
    """Common tokens without which a set of ``n`` reaches no similarity of ``percent``."""
    return -(-n * percent // 100)


def prefixes(tokens: np.ndarray, held: np.ndarray, n: int, percent: int) -> list[np.ndarray]:
    """The repeated tokens in a set's prefix under each order."""
    rest = n - needed(n, percent) + 1 - (n - len(tokens))  # unique tokens stand before all others
    out = []
    for k in range(ORDERS):
        rarity = held if k == 0 else np.floor(np.log2(held) / k)
        tie = mix(tokens + np.uint64(k + 1))
        out.append(tokens[np.lexsort((tie, rarity))[:max(0, rest)]])
    return out


def _lists(rows: list, kind) -> pa.Array:
    offsets = [0]
    nulls = [r is None for r in rows]
    for r in rows:
        offsets.append(offsets[-1] + (0 if r is None else len(r)))
    values = np.concatenate([np.zeros(0, kind), *[r for r in rows if r is not None]])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values),
                                    mask=pa.array(nulls) if rows else None)


def token_sets(blocks: DataFrame, repeated: DataFrame, bits: int, percent: int, words: int = WORDS) -> DataFrame:
    """A row per document; ``set``, ``tokens`` and prefixes only where it may have a link."""
    shift = np.uint64(64 - bits)

    def sets(left: pa.Table, right: pa.Table) -> pa.Table:
        known, counts = R.reply(right)
        data, offsets = R.doc_bytes(left["body"])
        n_rows = left.num_rows
        n, name = [0] * n_rows, [None] * n_rows
        tokens, central = [None] * n_rows, [None] * n_rows
        pre = [[None] * n_rows for _ in range(ORDERS)]
        for i, keys in shingle_sets(data, offsets, words):
            n[i] = len(keys)
            held = R.look_up(keys >> shift, known, counts)
            many = held > 1
            if many.sum() < needed(len(keys), percent):
                continue
            name[i] = hashlib.blake2b(keys.tobytes(), digest_size=16).digest()
            tokens[i] = keys[many].view(np.int64)
            central[i] = float(held.mean())
            for k, p in enumerate(prefixes(keys[many], held[many], len(keys), percent)):
                pre[k][i] = p.view(np.int64) if k == 0 else (p >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return pa.table({
            "rid": left["rid"], "block": left["block"], "ord": left["ord"], "n": pa.array(n, pa.int64()),
            "name": pa.array(name, pa.binary()), "central": pa.array(central, pa.float64()),
            "tokens": _lists(tokens, np.int64), "p0": _lists(pre[0], np.int64),
            **{f"p{k}": _lists(pre[k], np.int32) for k in range(1, ORDERS)}})

    return (blocks.select("block", "rid", "ord", "body").groupBy("block")
            .cogroup(repeated.groupBy("block")).applyInArrow(
                sets, "rid long, block long, ord long, n long, name binary, central double, tokens array<long>, "
                      "p0 array<long>, " + ", ".join(f"p{k} array<int>" for k in range(1, ORDERS))))


def _least_common(n: Column, m: Column, percent: int) -> Column:
    """Tokens that sets of ``n`` and ``m`` must share to be near enough."""
    return F.floor(((n + m) * percent + 99 + percent) / (100 + percent)).cast("long")


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether sets of sizes ``n`` of which ``r`` tokens recur anywhere could be near enough."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (F.least(F.col(f"{x}r"), F.col(f"{y}r")) >= _least_common(n, m, percent)))


def _in_prefixes(x: str, y: str, percent: int) -> Column:
    """Whether a common token stands in the prefixes that this pair of sizes needs."""
    need = _least_common(F.col(f"{x}n"), F.col(f"{y}n"), percent)
    return (F.col(f"{x}pos") <= F.col(f"{x}n") - need) & (F.col(f"{y}pos") <= F.col(f"{y}n") - need)


def verified(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs ``a``, ``b``: those whose prefixes meet under every order
    and whose sets are similar enough."""
    cols = ["n", "r", "tokens", *[f"p{k}" for k in range(1, ORDERS)]]
    x = reps.select(F.col("cid").alias("a"), *[F.col(c).alias(f"{c}_a") for c in cols])
    y = reps.select(F.col("cid").alias("b"), *[F.col(c).alias(f"{c}_b") for c in cols])
    both = pairs.join(x, "a").join(y, "b")
    need = _least_common(F.col("n_a"), F.col("n_b"), percent)
    for k in range(1, ORDERS):  # recurring tokens in the prefixes of this pair of sizes
        heads = [F.slice(f"p{k}_{s}", 1, F.greatest(F.lit(0), F.col(f"r_{s}") - need + 1).cast("int")) for s in "ab"]
        both = both.where(F.arrays_overlap(*heads))
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.where(common * 100 >= (F.col("n_a") + F.col("n_b") - common) * percent).select("a", "b")


def rooted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members with the root of their component; tokens all of whose members have one go."""
    if roots is None:
        return members.withColumn("root", F.col("cid"))
    m = (members.join(roots, members["cid"] == roots["node"], "left").drop("node")
         .withColumn("root", F.coalesce("root", "cid")))
    mixed = m.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    return m.join(mixed, "token")


def star_pairs(members: DataFrame, draws: list[int], percent: int) -> DataFrame:
    """For each class one pair per draw: with the first of all classes of other
    components that share a prefix token with it. Draw 0 puts the most central
    first, the others go by hash among those with few tokens of their own."""
    def rank(draw: int) -> Column:
        alone = F.col("r") * (100 + percent) < F.col("n") * 2 * percent
        lead = -F.col("central") if draw == 0 else F.lit(0.0)
        return F.struct(alone.alias("alone"), lead.alias("lead"), F.xxhash64("cid", F.lit(draw)).alias("at"), "cid", "n", "r", "pos", "root")

    heads = members.groupBy("token").agg(*[F.min(rank(d)).alias(f"h{d}") for d in draws])
    met = members.join(heads, "token")
    best = met.groupBy("cid").agg(*[
        F.min(F.when((F.col(f"h{d}.root") != F.col("root")) & _possible("", f"h{d}.", percent)
                     & _in_prefixes("", f"h{d}.", percent), F.col(f"h{d}"))).alias(f"h{d}")
        for d in draws])
    pairs = best.select("cid", F.explode(F.array(*[F.col(f"h{d}.cid") for d in draws])).alias("head")).where("head is not null")
    return pairs.select(F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).distinct()


def _band(n: Column, percent: int) -> Column:
    """Band of a set's size: sizes near enough for a link lie in one band or the next."""
    return F.floor(F.log(n) / (max(math.log(100 / percent), 0.01) * 1.001))


def open_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs of the first order between classes of different components.

    The smaller set of a pair meets the larger ones of its own band and the next.
    """
    x, y = (members.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("cid", "n", "r", "pos", "root")]) for side in "xy")
    band = _band(F.col("x_n"), percent)
    x = x.withColumn("band", F.explode(F.array(band, band + 1)))
    y = y.withColumn("band", _band(F.col("y_n"), percent))
    return (x.join(y, ["token", "band"]).where("x_root <> y_root and (x_n < y_n or x_n = y_n and x_cid < y_cid)")
            .where(_possible("x_", "y_", percent) & _in_prefixes("x_", "y_", percent))
            .select(F.least("x_cid", "y_cid").alias("a"), F.greatest("x_cid", "y_cid").alias("b")).distinct())


class Classes(NamedTuple):
    """Documents grouped by equal sets."""

    blocks: DataFrame
    sets: DataFrame  # a row per document; ``name`` only where it may have a link
    classes: DataFrame  # n, name, cid (its smallest rid), least (ord, rid), size
    reps: DataFrame  # the sets of one document a class
    members: DataFrame  # the classes' prefix tokens under the first order


def equal_sets(docs: DataFrame, ws: Workspace, percent: int, words: int, id_col: str, text_col: str) -> Classes:
    blocks = R.write_blocks(docs, ws, id_col, text_col)
    bits = R.key_bits(blocks, 0.2)
    repeated = R.repeated_keys(blocks, lambda d, o: shingle_sets(d, o, words), bits, ws)
    sets = ws.write(token_sets(blocks, repeated, bits, percent, words), "sets")

    maybe = sets.where("name is not null")
    classes = ws.write(maybe.groupBy("n", "name").agg(
        F.min("rid").alias("cid"), F.min(F.struct("ord", "rid")).alias("least"), F.count(F.lit(1)).alias("size")), "classes")
    reps = ws.write(maybe.join(classes.select("cid"), maybe["rid"] == classes["cid"])
                    .select("cid", "n", F.size("tokens").cast("long").alias("r"), "central", "tokens",
                            *[f"p{k}" for k in range(ORDERS)]), "reps")
    members = reps.select("cid", "n", "r", "central", F.posexplode("p0").alias("pos", "token"))
    members = members.withColumn("pos", F.col("pos") + F.col("n") - F.col("r"))  # behind the set's own tokens
    return Classes(blocks, sets, classes, reps, members)


def ngram_join(docs: DataFrame, ws: Workspace, percent: int = 80, words: int = WORDS, id_col: str = "doc_id",
               text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Components of documents linked by 100 * intersection >= percent * union.

    Returns (a row per document: ``rid``, ``block``, ``ord``, ``n_shingles``,
    ``root_ord`` (smallest id of its component) and ``first`` (whether it is the
    one row that stands for its component), the documents in blocks).
    """
    blocks, sets, classes, reps, members = equal_sets(docs, ws, percent, words, id_col, text_col)
    maybe = sets.where("name is not null")
    links = roots = None
    for i, draws in enumerate([*DRAWS, None]):
        m = rooted(members, roots)
        pairs = open_pairs(m, percent) if draws is None else star_pairs(m, draws, percent)
        found = ws.write(verified(pairs, reps, percent), f"links-{i}")
        links = found if links is None else links.unionByName(found)
        roots = connected_components(links, ws, f"roots-{i}")

    placed = classes.join(roots, classes["cid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "cid"))
    least = placed.groupBy("root").agg(F.min("least").alias("top"))
    named = placed.join(apart(least), "root").select("n", "name", "top")
    known = (maybe.select("rid", "block", "ord", "n", "name").join(named, ["n", "name"])
             .select("rid", "block", "ord", "n", F.col("top.ord").alias("root_ord"), (F.col("top.rid") == F.col("rid")).alias("first")))
    alone = sets.where("name is null").select("rid", "block", "ord", "n", F.col("ord").alias("root_ord"),
                                              F.lit(True).alias("first"))
    return known.unionByName(alone).withColumnRenamed("n", "n_shingles"), blocks


def ngram_links(docs: DataFrame, ws: Workspace, percent: int = 80, words: int = WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every link, as pairs between classes of equal sets, and who belongs to each class.

    Returns (a row per document: ``rid``, ``block``, ``ord``, ``n_shingles``, ``class``
    (the ``rid`` that names its class), ``n_links`` (other documents it is linked with);
    the linked pairs of classes ``a`` < ``b``; the documents in blocks). Copies of a text
    are linked by their class, not pair by pair.
    """
    blocks, sets, classes, reps, members = equal_sets(docs, ws, percent, words, id_col, text_col)
    pairs = ws.write(verified(open_pairs(rooted(members, None), percent), reps, percent), "pairs")
    ends = pairs.unionByName(pairs.select(F.col("a").alias("b"), F.col("b").alias("a")))
    far = ends.join(classes.select(F.col("cid").alias("b"), "size"), "b").groupBy("a").agg(F.sum("size").alias("far"))
    counted = (classes.join(far, classes["cid"] == far["a"], "left")
               .select("n", "name", F.col("cid").alias("class"), (F.col("size") - 1 + F.coalesce("far", F.lit(0))).alias("n_links")))
    shown = ["rid", "block", "ord", F.col("n").alias("n_shingles"), "class", "n_links"]
    known = sets.where("name is not null").join(counted, ["n", "name"]).select(*shown)
    alone = sets.where("name is null").select(*shown[:4], F.col("rid").alias("class"), F.lit(0).cast("long").alias("n_links"))
    return known.unionByName(alone), pairs, blocks


def digest(found: DataFrame) -> DataFrame:
    def shown(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c))

    return found.select(shown("ord").alias("doc_id"), "n_shingles", shown("root_ord").alias("component_id"))


def representatives(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows that stand for their components, as they were."""
    kept = found.where("first").groupBy("block").agg(F.collect_list("rid").alias("rids"))  # a block's rows at most
    return blocks.join(kept, "block").where(F.array_contains("rids", F.col("rid")))


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g FROM words),
tokens AS (SELECT doc_id, unnest(g) AS t FROM grams),
shared AS (SELECT t FROM tokens GROUP BY t HAVING count(*) > 1),
few AS (SELECT doc_id, t FROM tokens JOIN shared USING (t)),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM few x JOIN few y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN grams x ON x.doc_id = a JOIN grams y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.g) + len(y.g) - n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT r.doc_id, any_value(len(g.g))::BIGINT AS n_shingles, min(r.other) AS component_id
FROM reach r JOIN grams g ON g.doc_id = r.doc_id GROUP BY r.doc_id
"""
