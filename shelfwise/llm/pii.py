"""Personal data: candidate spans, boosted trees, calibrated thresholds; DataFrame functions alone.

Base kinds are found by their expressions and checks.  Further generators propose spans of high
recall that may overlap: loosely written addresses, groups of digits, dotted numbers and account
numbers (their lengths are bounded by the repeats in ``GENERATORS``, which only added spans feel).
Each candidate has features of its format (length, digits, groups, separators, letters, a Luhn sum)
and of its context (words before and after).

What is learnt.  In all documents, candidates that overlap a base span are positive.
They all have the trait by which the base expression knows them, so each is also given once or
twice with that trait masked before its features are taken (``MASKS``: the plus sign or the
country number of a phone, the sign and the dots of an address).  A candidate without a base span
is unlabelled, not negative: it is left out if its shape (letters and digits replaced by one
letter each) is that of a masked positive, unless there are more than ``COMMON`` times as many
such unlabelled candidates as masked ones.  All others are negative: numbers in plain contexts.

Candidates of one shape and the same features are one example with their number as its weight, so
every candidate counts while examples stay few.  Gradient boosted trees are fitted on those of two
thirds of the documents.  On the other third each generator gets its own least threshold, a multiple
of 1 / ``STEPS``, at which ``PRECISION`` of its masked positives and negatives are positive; a
generator without masked positives adds nothing.  Candidates that reach their generator's threshold
and overlap no base span are added; base spans always stay.

The trees become one column expression, and spans, features and scores live in arrays of their
document's row, so nothing is shuffled but the examples, counted before they move.

Defined cases: null and empty texts have no spans; without both classes of candidates, or without a
threshold of that precision, nothing is added; rows are judged one by one, so repeated rows get the
same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import documents, stored

TREES, DEPTH, PRECISION, COMMON = 20, 4, 0.98, 3
#: Least number of candidates in a leaf, and steps of a threshold.
LEAF, STEPS = 3, 10_000

# Expressions of the base kinds.  \G and the look-behind only skip starts inside a run whose own start
# would match as well, and possessive repeats never need to give back: the matches are the plain ones.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators of candidates beside the base kinds: name, expression, and what a text must hold to be searched.
GENERATORS = (
    ("loose_email", r"[A-Za-z0-9._%+-]{2,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{2,64}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}){1,4}", r"@|[(\[]at[)\]]"),
    ("digits", r"\+?[(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,24}", "[0-9]"),
    ("dotted", r"[0-9]{1,4}(?:\.[0-9]{1,4}){2,7}", r"[0-9]\.[0-9]"),
    ("account", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}", "[A-Z]{2}[0-9]{2}"),
)
BASE = ("email", "ip", "card", "phone")


def located(text: Column, pattern: str, needs: str) -> Column:
    """Matches of the expression with their places in code points: array of (start, end, match, before, after).

    Matches and the stretches between them alternate, so places are running sums of lengths.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")
    walk = F.aggregate(
        F.zip_with(between, found, lambda b, m: F.struct(F.char_length(b).alias("gap"), m.alias("match"))),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.when(x["match"].isNull(), acc).otherwise(F.struct(
            (acc["at"] + x["gap"] + F.char_length(x["match"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.char_length(x["match"])).alias("end"),
                x["match"].alias("match")))).alias("out"))),
        lambda acc: acc["out"])
    return F.when(text.rlike(needs), walk).otherwise(empty)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The digits pass Luhn's check."""
    n = F.length(digits)
    values = F.transform(F.split(digits, ""), lambda c, i: F.when((n - i) % 2 == 0, c.try_cast("int") * 2 - F.when(c.try_cast("int") > 4, 9).otherwise(0))
                         .otherwise(c.try_cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind that pass their checks."""
    size = lambda s: F.length(digits_of(s["match"]))
    octets = lambda s: F.forall(F.split(s["match"], r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return {"email": located(text, EMAIL, "@"),
            "ip": F.filter(located(text, IP, r"[0-9]\.[0-9]"), octets),
            "card": F.filter(located(text, CARD, "[0-9]"), lambda s: size(s).between(14, 19) & F.when(size(s).between(14, 19), luhn(digits_of(s["match"]))).otherwise(False)),
            "phone": F.filter(located(text, PHONE, r"\+[0-9]"), lambda s: size(s).between(10, 15))}


#: Features of a candidate c (start, end, match, kind, left, right), by name.
FEATURES = {
    "kind": lambda c: c["kind"],
    "length": lambda c: F.length(c["match"]),
    "digits": lambda c: F.length(digits_of(c["match"])),
    "letters": lambda c: F.length(F.regexp_replace(c["match"], "[^A-Za-z]", "")),
    "blanks": lambda c: F.length(F.regexp_replace(c["match"], r"[^\x20]", "")),
    "dashes": lambda c: F.length(F.regexp_replace(c["match"], "[^-]", "")),
    "dots": lambda c: F.length(F.regexp_replace(c["match"], "[^.]", "")),
    "brackets": lambda c: F.length(F.regexp_replace(c["match"], "[^()]", "")),
    "at": lambda c: c["match"].contains("@").cast("int"),
    "plus": lambda c: c["match"].startswith("+").cast("int"),
    "groups": lambda c: F.size(F.split(c["match"], "[^0-9]+")),
    "longest": lambda c: F.array_max(F.transform(F.split(c["match"], "[^0-9]+"), F.length)),
    "luhn": lambda c: luhn(digits_of(c["match"])).cast("int"),
    "left_word": lambda c: c["left"].rlike(r"[A-Za-z0-9]$").cast("int"),
    "left_mark": lambda c: c["left"].rlike(r"[=:\"'/]\s?$").cast("int"),
    "right_word": lambda c: c["right"].rlike(r"^[A-Za-z0-9]").cast("int"),
    "named": lambda c: c["left"].rlike(NAMES).cast("int"),
    "named_after": lambda c: c["right"].rlike(NAMES).cast("int"),
}
NAMES = r"(?i)(phone|tel|call|mobile|mail|contact|card|account|iban|ssn|ip|host)"
#: Code points of context on either side.
CONTEXT = 24
#: What a positive candidate looks like without the trait of its base kind: number of the generator, expression, replacements.
MASKS = ((0, "@", r"^(.*?)@(.*)$", r"$1(at)$2"), (0, "@", r"^([^@]*)@([^.]*)\.(.*)$", r"$1 [at] $2 [dot] $3"),
         (1, r"^\+", r"^\+", ""), (1, r"^\+[0-9]{1,3}[\x20.-]", r"^\+[0-9]{1,3}[\x20.-]+", ""))


def candidates(text: Column, base: dict[str, Column]) -> tuple[Column, Column]:
    """Candidates of all generators, (start, end, match, kind), and the places of all base spans."""
    spans = F.concat(*[F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for s in base.values()])
    def of_kind(n):
        return lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), F.lit(n).alias("kind"))

    return F.concat(*[F.transform(located(text, p, needs), of_kind(n)) for n, (_, p, needs) in enumerate(GENERATORS)]), spans


def shape(s: Column) -> Column:
    """Letters as a, digits as 0, other characters as they are."""
    return F.regexp_replace(F.regexp_replace(s, "[A-Za-z]", "a"), "[0-9]", "0")


def _features(c: Column) -> Column:
    return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["known"].alias("known"),
                    *[f(c).cast("double").alias(f"f_{n}") for n, f in FEATURES.items()])


def _masked(c: Column) -> Column:
    """The known candidate without the trait of its base kind, in the ways that apply to it."""
    def one(number, has, pattern, rest):
        changed = F.struct(c["start"].alias("start"), c["end"].alias("end"), F.regexp_replace(c["match"], pattern, rest).alias("match"),
                           c["kind"].alias("kind"), c["left"].alias("left"), c["right"].alias("right"), c["known"].alias("known"))
        return F.when(c["known"] & (c["kind"] == number) & c["match"].rlike(has), changed)

    return F.filter(F.array(*[one(*m) for m in MASKS]), lambda x: x.isNotNull())


def with_spans(docs: DataFrame, keep: list[Column], learning: bool = False) -> DataFrame:
    """keep columns, one array of spans for each base kind, and cands: the candidates with their features.

    For learning also the candidates' shapes, and masked and their shapes.
    """
    d = docs.select(*keep, "text", *[s.alias(k) for k, s in base_spans(F.col("text")).items()])
    every, spans = candidates(F.col("text"), {k: F.col(k) for k in BASE})
    d = d.select("*", every.alias("every"), spans.alias("spans"))
    around = F.transform("every", lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), x["kind"].alias("kind"),
        F.substring(F.col("text"), F.greatest(x["start"] - CONTEXT + 1, F.lit(1)), F.least(x["start"], F.lit(CONTEXT))).alias("left"),
        F.substring(F.col("text"), x["end"] + 1, F.lit(CONTEXT)).alias("right"),
        F.exists("spans", lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])).alias("known")))
    names = [n for n in d.columns if n not in ("text", "every", "spans")]
    d = d.select(*names, "text", around.alias("around"))
    if not learning:
        return d.select(*names, F.transform("around", _features).alias("cands"))
    labelled = lambda masked: lambda x: F.struct(_features(x).alias("c"), shape(x["match"]).alias("shape"), F.lit(masked).alias("masked"))
    return d.select(*names, F.concat(F.transform("around", labelled(False)),
                                     F.transform(F.flatten(F.transform("around", _masked)), labelled(True))).alias("cands"))


def _tree(node, c: Column, names: list[str]) -> Column:
    """A fitted tree as an expression of a candidate's features."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(c[f"f_{names[split.featureIndex()]}"] <= float(split.threshold()), _tree(node.leftChild(), c, names)).otherwise(
        _tree(node.rightChild(), c, names))


def examples(docs: DataFrame) -> DataFrame:
    """fold, gen, masked, label, features and n: the candidates to learn from, of all documents, equal ones counted."""
    fold = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(3))
    d = docs.filter(F.col("text").rlike(r"[0-9@]|[(\[]at[)\]]")).withColumn("fold", fold)
    # explode_outer: for explode, the optimiser would find all candidates once more to test for empty arrays
    x = with_spans(d, [F.col("fold")], learning=True).select("fold", F.explode_outer("cands").alias("x")).filter("x is not null")
    kinds = ["fold", "gen", "shape", "masked", "known"]
    every = (x.select("fold", F.col("x.c.kind").alias("gen"), "x.shape", "x.masked", F.col("x.c.known").alias("known"),
                      *[f"x.c.f_{n}" for n in FEATURES]))
    rows = stored(every.groupBy(*kinds, *[f"f_{n}" for n in FEATURES]).agg(F.count("*").cast("double").alias("n")))
    number = lambda of, name: F.sum(F.when(of, F.col("n")).otherwise(0.0)).alias(name)
    like = rows.groupBy("gen", "shape").agg(number(~F.col("known"), "open"), number(F.col("masked"), "hidden")).filter(F.col("hidden") > 0)
    unsure = like.filter(F.col("open") <= COMMON * F.col("hidden")).select("gen", "shape").withColumn("unsure", F.lit(True))
    label = F.col("known").cast("double").alias("label")
    features = [f"f_{n}" for n in FEATURES]
    return (rows.join(unsure, ["gen", "shape"], "left").filter(F.col("known") | F.col("unsure").isNull())
            .select("fold", "gen", "masked", label, *features, "n")
            .groupBy("fold", "gen", "masked", "label", *features).agg(F.sum("n").alias("n")))


def fit(docs: DataFrame):
    """(trees and weights, threshold of each generator by number) or None, learnt on the candidates of all documents."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = stored(examples(docs))
    seen = {(r.held, r.label): r.n for r in rows.groupBy((F.col("fold") == 0).alias("held"), "label").agg(F.sum("n").alias("n")).collect()}
    if len(seen) < 4:
        return None
    total = seen[False, 0.0] + seen[False, 1.0]
    train = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(rows.filter("fold <> 0"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=13, weightCol="n",
                          minWeightFractionPerNode=min(0.49, LEAF / total)).fit(train.select("features", "label", "n"))
    jvm = list(model._java_obj.trees())
    trees = [(t.rootNode(), float(w)) for t, w in zip(jvm, model.treeWeights)]
    judged = rows.filter("fold = 0 and (masked or label = 0)")
    step = F.floor(score(trees, F.struct(*[f"f_{n}" for n in FEATURES])) * STEPS).alias("step")
    scored = judged.groupBy("gen", step).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good")).collect()  # STEPS rows a generator at most
    limits = {}
    for kind in {r.gen for r in scored}:
        limit = least_threshold([(r.step, r.n, r.good) for r in scored if r.gen == kind])
        if limit is not None:
            limits[kind] = max(limit / STEPS, 0.5)
    return (trees, limits) if limits else None


def least_threshold(scored: list[tuple[int, float, float]]) -> int | None:
    """Of (step, rows, positive rows) the least step from which on PRECISION of the rows are positive; None if there is none."""
    rows = good = 0.0
    found = None
    for step, n, positive in sorted(scored, reverse=True):
        rows, good = rows + n, good + positive
        if good and good >= PRECISION * rows:
            found = step
    return found


def score(trees: list, c: Column) -> Column:
    """Probability that a candidate is personal data."""
    margin = F.lit(0.0)
    for root, weight in trees:
        margin = margin + weight * _tree(root, c, list(FEATURES))
    return 1.0 / (1.0 + F.exp(-2.0 * margin))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans), spans (base and added ones)."""
    src = documents(docs)
    learnt = fit(src)
    d = with_spans(src, [F.col("doc_id")])
    order = {k: n for n, k in enumerate((*BASE, *(n for n, _, _ in GENERATORS)))}

    def of_kind(n):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("kind"), x["end"].alias("end"))

    base = F.concat(*[F.transform(k, of_kind(order[k])) for k in BASE])
    d = d.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], base.alias("base"), "cands")
    added = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if learnt:
        trees, limits = learnt
        limit = lambda c: F.get(F.array(*[F.lit(float(limits.get(k, 2.0))) for k in range(len(GENERATORS))]), c["kind"])
        passed = F.filter("cands", lambda c: ~c["known"] & c["kind"].isin(*limits) & (F.floor(score(trees, c) * STEPS) >= F.round(limit(c) * STEPS)))
        added = F.transform(passed, lambda c: F.struct(c["start"].alias("start"), (c["kind"] + len(BASE)).alias("kind"), c["end"].alias("end")))
    listed = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, order)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return d.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                    listed(F.concat("base", added)).alias("spans"))
