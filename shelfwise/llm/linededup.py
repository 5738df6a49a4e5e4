"""Removal of repeated runs of lines, with DataFrame functions alone.

A document is its sequence of lines that are not blank; a suffix is what follows from one of
them.  Suffixes are ordered by prefix doubling.  The name of a suffix at depth 1 is a 128-bit hash
of its line, and at depth 2h the hash of its names h lines apart; a last step overlaps two names to
reach the least run, ``min_lines``.  Up to there a name depends on the lines of one array alone and
tasks agree on names without an exchange.  Then suffixes whose name no other has leave, and so does
every suffix that would need one of them further on.  Those that stay are given the names of 2, 4,
8, ... times as many windows of ``min_lines`` lines, a few steps for each exchange, again and again
until none has a name that another has.

Suffixes with one name are an interval of the suffix array whose longest common prefix reaches
the depth.  Such an interval with two members or more is a repeated run; all its members but the
first (least doc_id, then place) are later copies, at the deepest depth they share.  Where later
copies touch or overlap they join into maximal runs, which are deleted: a run of any length that
has an earlier copy is covered from end to end by the copies of the largest power of two of
windows in it.  A line of ``min_chars`` characters or more is a run by itself.

Intervals are aggregated to one row (their first member) with a map-side combine, and the
members are joined back to it: a run that a third of all documents share is one row on the
unique side, and its skewed part on the other side can be split.

Defined cases: blank lines are kept and lie in no run; null and empty texts have one line and
lose nothing; rows with one doc_id and text count as one document and get the same result; a
null id is ordered last; a document whose lines all go keeps an empty text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, stored

MIN_LINES, MIN_CHARS = 2, 250
#: Steps of doubling for each exchange of names.
DOUBLINGS = 5
#: A null doc_id is ordered last, as this number.
LAST = (1 << 63) - 1


def _names(lines: Column) -> Column:
    """Depth 1: place, both halves of the name, and whether the line is a run by itself."""
    return F.transform(lines, lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(7), x["line"]).alias("b"),
        (F.char_length(x["line"]) >= F.col("__sw_min")).alias("own")))


def _joined(names: Column, step: int) -> Column:
    """Names of twice the depth (less their overlap): those ``step`` lines apart, hashed together; shorter suffixes drop out."""
    n = F.greatest(F.size(names) - step, F.lit(0))
    return F.zip_with(F.slice(names, F.lit(1), n), F.slice(names, F.lit(1 + step), n), lambda x, y: F.struct(
        x["at"].alias("at"), F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(x["b"], y["b"]).alias("b"), x["own"].alias("own")))


def _numbered(text: Column | str) -> Column:
    """The lines that are not blank, with their numbers in the text."""
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
                    lambda x: x["line"].rlike("[^\\x20\\x09-\\x0D]"))


def suffixes(rows: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, key, p (place among the lines that are not blank), n (lines) and name (a, b) of each suffix at the least depth."""
    d = (rows.withColumn("__sw_min", F.lit(min_chars)).withColumn("lines", _numbered("text"))
         .select("doc", "key", _names(F.col("lines")).alias("one")).filter(F.size("one") > 0))
    d, depth = d.withColumn("deep", F.col("one")), 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        d, depth = d.withColumn("deep", _joined(F.col("deep"), step)), depth + step
    # a long line is a run by itself, at depth 1, beside the run of min_lines lines that starts with it
    alone = F.filter(F.transform("one", lambda x, p: F.struct(p.alias("p"), F.lit(1).alias("n"), x["a"].alias("a"), x["b"].alias("b"), x["own"].alias("own"))),
                     lambda x: x["own"])
    deep = F.transform("deep", lambda x, p: F.struct(p.alias("p"), F.lit(min_lines).alias("n"), x["a"].alias("a"), x["b"].alias("b"), x["own"].alias("own")))
    return (d.select("doc", "key", F.explode(F.concat(alone, deep) if min_lines > 1 else deep).alias("s"))
            .select("doc", "key", F.col("s.p").alias("p"), F.col("s.n").alias("n"), F.col("s.a").alias("a"), F.col("s.b").alias("b")))


def repeated(named: DataFrame) -> DataFrame:
    """The suffixes whose name another has as well, and whether each is a later copy."""
    here = F.struct("doc", "key", "p")
    groups = (named.groupBy("a", "b").agg(F.min(here).alias("first"), F.max(here).alias("last"))
              .filter("first <> last").select("a", "b", "first"))
    return named.join(groups, ["a", "b"]).select("doc", "key", "p", "n", "a", "b", (here != F.col("first")).alias("later"))


def deepened(found: DataFrame, windows: int) -> DataFrame:
    """Names of 2, 4, ... times as many windows (``DOUBLINGS`` steps): of a suffix and the one as far on, where that has a name.

    The suffixes of a document are moved once for all steps.  Only suffixes that are repeated at the depth given have names.
    """
    by_place = Window.partitionBy("doc", "key").orderBy("p")
    d, steps = found.withColumn("name0", F.struct("n", "a", "b")), range(DOUBLINGS)
    for k in steps:
        step, name = windows << k, F.col(f"name{k}")
        d = d.withColumn("to", F.first(name).over(by_place.rangeBetween(step, step)))
        d = d.withColumn(f"name{k + 1}", F.when(name.isNotNull() & F.col("to").isNotNull(), F.struct(
            (name["n"] + step).alias("n"), F.xxhash64(name["a"], "to.a").alias("a"), F.xxhash64(name["b"], "to.b").alias("b"))))
    names = F.filter(F.array(*[f"name{k + 1}" for k in steps]), lambda x: x.isNotNull())
    return d.select("doc", "key", "p", F.explode(names).alias("s")).select("doc", "key", "p", "s.*")


def copies(rows: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, key, p and n: n lines from place p on are the later copy of a repeated run; for each depth that they share."""
    names = stored(suffixes(rows, min_lines, min_chars))      # read twice: names cost more than their storage
    found, windows = stored(repeated(names)), 1
    out = []
    while True:
        out.append(found.filter("later").select("doc", "key", "p", "n"))
        found = found.filter(F.col("n") == windows + min_lines - 1)     # a long line alone has no names further on
        if found.isEmpty():
            return reduce(DataFrame.unionByName, out)
        found, windows = stored(repeated(deepened(found, windows))), windows << DOUBLINGS


def later_runs(rows: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, key and runs (place p and length n of the maximal runs to delete, in order) of each document that has later copies."""
    by_place = Window.partitionBy("doc", "key").orderBy("p")
    end = F.max(F.col("p") + F.col("n")).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(end < F.col("p"), F.lit(True)).cast("int")
    return (copies(rows, min_lines, min_chars).withColumn("apart", apart)
            .withColumn("run", F.sum("apart").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc", "key", "run").agg(F.min("p").alias("p"), F.max(F.col("p") + F.col("n")).alias("end"))
            .groupBy("doc", "key").agg(F.sort_array(F.collect_list(F.struct("p", (F.col("end") - F.col("p")).alias("n")))).alias("runs")))


def _gone(text: Column | str) -> Column:
    """Numbers of the lines in ``runs``, in order; null without runs."""
    places = F.transform(_numbered(text), lambda x: x["at"])
    # an array of one: the places are made once for all runs
    lines = F.transform(F.array(places), lambda at: F.flatten(F.transform("runs", lambda r: F.slice(at, r["p"] + 1, r["n"]))))[0]
    return F.when(F.col("runs").isNotNull(), lines)


def kept_text(text: Column) -> Column:
    """The text without the lines ``gone``; the whole text where ``gone`` is null."""
    # one flag for each line up to the last deleted one: as many false as lie between deleted lines, then true
    flags = F.flatten(F.transform("gone", lambda x, k: F.concat(F.array_repeat(F.lit(False), x - _before(k) - 1), F.array(F.lit(True)))))
    lines = F.zip_with(F.split(text, "\n", -1), flags, lambda x, f: F.when(~F.coalesce(f, F.lit(False)), x))
    return F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n"))


def _before(k: Column) -> Column:
    return F.when(k == 0, F.lit(-1)).otherwise(F.element_at("gone", F.greatest(k, F.lit(1))))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, n_runs (maximal deleted runs), kept_sha256 (of the text that stays)."""
    rows = (documents(docs).withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
            .withColumn("key", F.xxhash64("text")).select("doc", "key", "text"))
    found = rows.join(later_runs(rows, min_lines, min_chars), ["doc", "key"], "left").withColumn("gone", _gone("text"))
    return found.select(
        F.nullif("doc", F.lit(LAST)).alias("doc_id"),
        (F.char_length("text") - F.char_length(F.translate("text", "\n", "")) + 1).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).cast("long").alias("n_runs"), F.sha2(kept_text(F.col("text")), 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the same columns, later copies of repeated line runs deleted from text (a null text stays null)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    packed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("key"),
                         F.struct(*docs.columns).alias("row"))
    rows = packed.select("doc", "key", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"))
    found = (packed.join(later_runs(rows, min_lines, min_chars), ["doc", "key"], "left")
             .withColumn("gone", _gone(F.col("row.text").cast("string"))))
    return found.select(*[kept_text(F.col("row.text").cast("string")).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
                          for c in docs.columns])
