"""License scan by ordered signature rules.

Some hundreds of regular expressions, one per licence and kind of statement,
run over a text's words (ASCII letters lower-cased, every separator one blank),
so that a hit is an interval of words. Each rule has keys of its licence and keys
of its kind; all that it matches holds one of either, at a word's start, and only
texts that do are tried with its expression. The gate that decides whether a text
is scanned at all is the union of these keys over all rules. Of overlapping hits, one
that lies within another of higher priority (or of the same priority and not
shorter) is suppressed; hits of the three base phrases always stay. The labels
are those of the hits that remain; the score is the surest kind among them.

Native functions only: texts are read once, by one projection that leaves the
words between and within hits; positions are running sums over a document's
hits of one rule, and suppression a running maximum over its hits. A document
with very many hits is sorted, never compared pair by pair. Null texts count as
empty: no words, no hits. Rows keep their multiplicity; columns other than id
and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, ascii_lower, whole_text

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text

# Phrases and labels of the base contract.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@dataclass(frozen=True)
class Licence:
    """How texts name a licence, in lower-case words."""

    label: str
    keys: tuple[str, ...]  # one of them begins a word in whatever a rule of it matches; a blank at the end: is whole words
    name: str
    spdx: str
    title: str
    url: str


V = "(?:version |v ?)?"
LICENCES = (
    Licence("mit", ("mit ", "expat"), "(?:mit|expat|mit x11|x11 mit)", "mit", "the mit license mit", "opensource org licenses mit"),
    Licence("mit-0", ("mit ",), "mit (?:0|no attribution)", "mit 0", "mit no attribution", "opensource org licenses mit 0"),
    Licence("apache-1.1", ("apache",), f"apache(?: software)?(?: licen[sc]e)? {V}1 1", "apache 1 1", f"apache software license {V}1 1", "apache org licenses license 1 1"),
    Licence("apache-2", ("apache", "asl 2", "asl2"), f"(?:apache(?: software)?(?: licen[sc]e)? {V}2(?: 0)?|asl ?2(?: 0)?)", "apache 2(?: 0)?", "apache license version 2 0", "apache org licenses license 2 0"),
    Licence("bsd-2-clause", ("bsd", "freebsd"), "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd 2 clause", "bsd 2 clause license", "opensource org licenses bsd 2 clause"),
    Licence("bsd-3-clause", ("bsd",), "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", "bsd 3 clause", "bsd 3 clause license", "opensource org licenses bsd 3 clause"),
    Licence("bsd-4-clause", ("bsd",), "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd 4 clause", "bsd 4 clause license", "spdx org licenses bsd 4 clause"),
    Licence("0bsd", ("bsd", "0bsd"), "(?:0 ?bsd|zero clause bsd|bsd zero clause)", "0bsd", "bsd zero clause license", "opensource org licenses 0bsd"),
    Licence("gpl-1", ("gpl", "general public"), f"(?:gnu )?(?:gpl|general public licen[sc]e) ?{V}1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu general public license version 1", "gnu org licenses gpl 1 0"),
    Licence("gpl-2", ("gpl", "general public"), f"(?:gnu )?(?:gpl|general public licen[sc]e) ?{V}2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu general public license version 2", "gnu org licenses (?:old licenses )?gpl 2 0"),
    Licence("gpl-3", ("gpl", "general public"), f"(?:gnu )?(?:gpl|general public licen[sc]e) ?{V}3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu general public license version 3", "gnu org licenses gpl 3 0"),
    Licence("gpl", ("gpl", "general public"), "(?:gnu )?(?:gpl|general public)", "gpl", "gnu general public license as published by the free software foundation", "gnu org (?:licenses|copyleft) gpl"),
    Licence("lgpl-2.1", ("lgpl", "lesser general"), f"(?:gnu )?(?:lgpl|lesser general public licen[sc]e) ?{V}2 1", "lgpl 2 1(?: only| or later)?", "gnu lesser general public license version 2 1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    Licence("lgpl-3", ("lgpl", "lesser general"), f"(?:gnu )?(?:lgpl|lesser general public licen[sc]e) ?{V}3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu lesser general public license version 3", "gnu org licenses lgpl 3 0"),
    Licence("lgpl", ("lgpl", "lesser general", "library general"), "(?:gnu )?(?:lgpl|(?:lesser|library) general public)", "lgpl", "gnu lesser general public license", "gnu org (?:licenses|copyleft) lgpl"),
    Licence("agpl-3", ("agpl", "affero"), f"(?:gnu )?(?:agpl|affero general public licen[sc]e|affero gpl)(?: ?{V}3(?: 0)?)?", "agpl 3 0(?: only| or later)?", "gnu affero general public license", "gnu org licenses agpl"),
    Licence("gfdl", ("gfdl", "fdl", "free documentation"), f"(?:gnu )?(?:gfdl|fdl|free documentation)(?: licen[sc]e)?(?: {V}1 [123])?", "gfdl 1 [123](?: only| or later)?", "gnu free documentation license", "gnu org licenses fdl"),
    Licence("mpl-1.1", ("mpl", "mozilla"), f"(?:mpl|mozilla public licen[sc]e) ?{V}1 1", "mpl 1 1", "mozilla public license version 1 1", "mozilla org mpl 1 1"),
    Licence("mpl-2", ("mpl", "mozilla"), f"(?:mpl|mozilla public(?: licen[sc]e)?)(?: ?{V}2(?: 0)?)?", "mpl 2 0", "mozilla public license version 2 0", "mozilla org mpl 2 0"),
    Licence("epl-1", ("epl", "eclipse"), f"(?:epl|eclipse public(?: licen[sc]e)?) ?{V}1(?: 0)?", "epl 1 0", "eclipse public license v 1 0", "eclipse org legal epl v10"),
    Licence("epl-2", ("epl", "eclipse"), f"(?:epl|eclipse public(?: licen[sc]e)?)(?: ?{V}2(?: 0)?)?", "epl 2 0", "eclipse public license v 2 0", "eclipse org legal epl (?:v20|2 0)"),
    Licence("cddl", ("cddl", "common development"), f"(?:cddl|common development and distribution)(?: licen[sc]e)?(?: {V}1 [01])?", "cddl 1 [01]", "common development and distribution license", "opensource org licenses cddl"),
    Licence("cpl-1", ("cpl", "common public"), f"(?:cpl|common public)(?: licen[sc]e)?(?: {V}1(?: 0)?)?", "cpl 1 0", "common public license version 1 0", "opensource org licenses cpl"),
    Licence("artistic-2", ("artistic",), f"artistic(?: licen[sc]e)?(?: {V}2(?: 0)?)?", "artistic 2 0", "the artistic license 2 0", "opensource org licenses artistic"),
    Licence("bsl-1", ("boost", "bsl"), f"boost(?: software)?(?: licen[sc]e)?(?: {V}1(?: 0)?)?", "bsl 1 0", "boost software license version 1 0", "boost org license 1 0"),
    Licence("isc", ("isc ", "internet systems"), "(?:isc|internet systems consortium)", "isc", "isc license isc", "opensource org licenses isc"),
    Licence("zlib", ("zlib",), "(?:zlib|zlib libpng)", "zlib", "zlib license", "zlib net zlib license"),
    Licence("unlicense", ("unlicense", "unencumbered"), "unlicense", "unlicense", "this is free and unencumbered software released into the public domain", "unlicense org"),
    Licence("wtfpl", ("wtfpl", "what the f"), f"(?:wtfpl|do what the fuck you want to public)(?: {V}2)?", "wtfpl", "do what the fuck you want to public license", "wtfpl net"),
    Licence("psf-2", ("python", "psf"), f"(?:psf|python software foundation)(?: licen[sc]e)?(?: {V}2)?", "psf 2 0|python 2 0", "python software foundation license version 2", "python org psf license"),
    Licence("ofl-1.1", ("ofl ", "open font"), f"(?:sil )?(?:ofl|open font)(?: licen[sc]e)?(?: {V}1 1)?", "ofl 1 1", "sil open font license version 1 1", "scripts sil org ofl"),
    Licence("odbl", ("odbl", "open database"), f"(?:odbl|open database)(?: licen[sc]e)?(?: {V}1(?: 0)?)?", "odbl 1 0", "open database license", "opendatacommons org licenses odbl"),
    Licence("eupl", ("eupl", "european union public", "joinup"), f"(?:eupl|european union public)(?: licen[sc]e)?(?: {V}1 [12])?", "eupl 1 [12]", "european union public licence", "joinup ec europa eu .{0,40}eupl"),
    Licence("cc0", ("cc0", "cc 0", "cc zero", "creative commons", "creativecommons"), f"(?:cc ?0|cc zero|creative commons (?:zero|0))(?: {V}1 0)?", "cc0 1 0", "cc0 1 0 universal", "creativecommons org publicdomain zero"),
    Licence("cc-by", ("cc by", "creative commons", "creativecommons"), f"(?:cc by|creative commons attribution)(?! ?(?:nc|sa|nd|non ?commercial|share|no deriv))(?: {V}[1-4](?: 0)?)?", "cc by [1-4] 0", "creative commons attribution [1-4] 0", "creativecommons org licenses by [1-4]"),
    Licence("cc-by-sa", ("cc by", "creative commons", "creativecommons"), f"(?:cc by sa|creative commons attribution share ?alike)(?: {V}[1-4](?: 0)?)?", "cc by sa [1-4] 0", "creative commons attribution sharealike", "creativecommons org licenses by sa"),
    Licence("cc-by-nd", ("cc by", "creative commons", "creativecommons"), f"(?:cc by nd|creative commons attribution no ?deriv[a-z]*)(?: {V}[1-4](?: 0)?)?", "cc by nd [1-4] 0", "creative commons attribution noderivatives", "creativecommons org licenses by nd"),
    Licence("cc-by-nc", ("cc by", "creative commons", "creativecommons"), f"(?:cc by nc|creative commons attribution non ?commercial)(?! ?(?:sa|nd|share|no ?deriv))(?: {V}[1-4](?: 0)?)?", "cc by nc [1-4] 0", "creative commons attribution noncommercial", "creativecommons org licenses by nc [1-4]"),
    Licence("cc-by-nc-sa", ("cc by", "creative commons", "creativecommons"), f"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: {V}[1-4](?: 0)?)?", "cc by nc sa [1-4] 0", "creative commons attribution noncommercial sharealike", "creativecommons org licenses by nc sa"),
    Licence("cc-by-nc-nd", ("cc by", "creative commons", "creativecommons"), f"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv[a-z]*)(?: {V}[1-4](?: 0)?)?", "cc by nc nd [1-4] 0", "creative commons attribution noncommercial noderivatives", "creativecommons org licenses by nc nd"),
)

LICENCE, TERMS = "licen[sc]e", "(?:the )?(?:terms of )?(?:the )?"
# kind: (priority, sureness, keys as a licence's, pattern of a licence)
KINDS = {
    "tag": (5, 1.0, ("spdx ",), lambda x: f"spdx licen[sc]e identifier (?:{x.spdx})"),
    "grant": (4, 0.95, ("under ", "by "), lambda x: f"(?:licen[sc]ed|released|distributed|available|provided|published|covered|used|governed) "
                                                    f"(?:under|by) {TERMS}{x.name}(?: {LICENCE})?"),
    "terms": (4, 0.9, ("under ",), lambda x: f"under {TERMS}{x.name} {LICENCE}"),
    "address": (3, 0.9, ("http ", "https "), lambda x: f"https? (?:www )?{x.url}"),
    "title": (3, 0.8, ("licen", "attribution", "unencumbered", "universal"), lambda x: x.title),
    "field": (2, 0.7, ("licen",), lambda x: f"{LICENCE} (?:type |name |id |is )?(?:{x.spdx})"),
    "pointer": (2, 0.6, ("see ", "view ", "read "), lambda x: f"(?:see|view|read) (?:the )?{x.name}(?: {LICENCE})?(?: for| file| text)"),
    "mention": (1, 0.5, ("licen",), lambda x: f"{x.name} {LICENCE}[sd]?"),
}
BASE_PRIORITY, BASE_SURE = 4, 0.95
TOP = 5


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    sure: float
    keys: tuple[str, ...]
    kind_keys: tuple[str, ...]
    pattern: str
    base: bool = False


def rules() -> list[Rule]:
    """Base phrases, then every licence's pattern of every kind, surest kinds first."""
    out = [Rule(i, label, BASE_PRIORITY, BASE_SURE, (f" {phrase} ",), (f" {phrase} ",), phrase, True)
           for i, (phrase, label) in enumerate(BASE)]
    for priority, sure, kind_keys, pattern in KINDS.values():
        for x in LICENCES:
            out.append(Rule(len(out), x.label, priority, sure, _at_words(x.keys), _at_words(kind_keys), pattern(x)))
    return out


def _at_words(keys: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(f" {k}" for k in keys)


def union(keys: set[str]) -> str:
    """A pattern of lower-case text, or of its words, that holds any of the keys (blanks: any
    separators, or the text's ends). Keys that hold another add nothing and are left out."""
    def spaced(k: str) -> str:
        return SEPARATORS.join(k.strip().split(" ")) + (f"(?:$|{SEPARATORS})" if k.endswith(" ") else "")

    by_letter: dict[str, list[str]] = {}
    for k in sorted(k for k in keys if not any(o != k and o in k for o in keys)):
        by_letter.setdefault(k[1], []).append(spaced(k[2:]) if len(k.strip()) > 1 else "")
    return f"(?:^|{SEPARATORS[:-1]})(?:{'|'.join(f'{a}(?:{chr(124).join(rest)})' for a, rest in by_letter.items())})"


def gate(found: list[Rule]) -> tuple[str, str]:
    """Patterns of which every text that a rule may match holds both."""
    return union({k for r in found for k in r.keys}), union({k for r in found for k in r.kind_keys})


GATE: tuple[str, ...] = ()  # strings that let a text pass wherever they stand: none
GATE_PATTERN, KIND_PATTERN = gate(rules())


def bounded(pattern: str) -> str:
    """The pattern as whole words between blanks."""
    return f"(?<= )(?:{pattern})(?= )"


def _rule_array(found: list[Rule]) -> Column:
    """Rules in groups of equal keys."""
    groups: dict[tuple, list[Rule]] = {}
    for r in found:
        groups.setdefault(r.keys, []).append(r)
    return F.array(*[F.struct(F.array(*map(F.lit, keys)).alias("keys"), F.array(*[
        F.struct(F.lit(r.number).alias("number"), F.array(*map(F.lit, r.kind_keys)).alias("keys"),
                 F.lit(bounded(r.pattern)).alias("pattern")) for r in some]).alias("rules")) for keys, some in groups.items()])


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def word_text(text: Column) -> Column:
    """Words with a blank before, between and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), SEPARATORS, " ")), F.lit(" "))


def _hits(words: Column, found: list[Rule]) -> Column:
    """Per rule that hits: words before each hit (since the last one) and in it."""
    def steps(r: Column) -> Column:
        between, within = F.split(words, r["pattern"], -1), F.regexp_extract_all(words, r["pattern"], F.lit(0))
        return F.struct(r["number"].alias("number"), F.zip_with(
            F.slice(between, 1, F.size(within)), within,
            lambda b, w: F.struct((_blanks(b) - 1).alias("gap"), (_blanks(w) + 1).alias("len"))).alias("steps"))

    def held(r: Column) -> Column:
        return F.exists(r["keys"], lambda k: F.contains(words, k))

    tried = F.filter(F.flatten(F.transform(F.filter(_rule_array(found), held), lambda g: g["rules"])), held)
    return F.filter(F.transform(tried, steps), lambda h: F.size(h["steps"]) > 0)


def scan_licences(docs: DataFrame, ws: Workspace, found: list[Rule] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows: ``rid``, ``doc_id``, ``n_words``; detections that hit: ``rid``, ``start``
    and ``end`` in words, ``label``, ``priority``, ``sure``, ``base``, ``kept``)."""
    found = rules() if found is None else found
    words = F.col("words")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       word_text(whole_text(text_col)).alias("words"))
    names, kinds = gate(found)
    rows = ws.write(rows.select(
        "doc_id", "rid", F.when(words == "  ", 0).otherwise(_blanks(words) - 1).cast("long").alias("n_words"),
        F.when(words.rlike(names) & words.rlike(kinds), _hits(words, found)).alias("hits")), "rows")

    each = rows.select("rid", F.explode("hits").alias("hit"))
    each = each.select("rid", "hit.number", F.posexplode("hit.steps").alias("nth", "step"))
    so_far = Window.partitionBy("rid", "number").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    each = (each.withColumn("end", F.sum(F.col("step.gap") + F.col("step.len")).over(so_far).cast("long"))
            .withColumn("start", F.col("end") - F.col("step.len")))
    spark = docs.sparkSession
    known = spark.createDataFrame([(r.number, r.label, r.priority, r.sure, r.base) for r in found],
                                  "number int, label string, priority int, sure double, base boolean")
    each = each.join(F.broadcast(known), "number")  # one row a rule
    before = (Window.partitionBy("rid").orderBy("start", F.col("end").desc(), F.col("priority").desc(), "number")
              .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.coalesce(*[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before))
                         for p in range(1, TOP + 1)], F.lit(-1))
    hits = each.withColumn("kept", F.col("base") | (reach < F.col("end")))
    return rows.drop("hits"), hits.select("rid", "start", "end", "label", "priority", "sure", "base", "kept")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.collect_set(labels), lambda x: x.isNotNull())), ",")


def digest(rows: DataFrame, hits: DataFrame) -> DataFrame:
    base = F.col("base")
    per = hits.groupBy("rid").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), _joined(F.when(base, F.col("label"))).alias("base_labels"),
        _joined(F.when(F.col("kept"), F.col("label"))).alias("labels"), F.max(F.when(F.col("kept"), F.col("sure"))).alias("score"),
        F.count_if("kept").alias("n_kept"))
    out = rows.join(per, "rid", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"))
