"""Personal data by candidate gradient boosting, in DataFrame functions and JVM models only.

1. Generators propose spans: four strict ones (the base patterns) and looser ones of the same kinds. Proposals may overlap.
   Documents shrink to their proposals here: match, gap to the one before, a little context on both sides.
2. A proposal of a strict generator that passes its kind's check is a base span, and always stays.
3. Boosted trees score every proposal by format and context. They learn from all labelled examples. A base
   span is a positive one, and so is the same span written the way a loose generator expects it (``a [at] b [dot] c``, a
   number without its country code, a card with dots), in the place where it stands. Negative are strict matches that fail
   their check, the same in disguise, and loose proposals that are named as something else (an order, a hash, a version) or
   are part of a longer word or number. Loose proposals without such a mark have no label: they are what the trees are for.
   On a held-out part of the examples each kind gets the lowest threshold from which on the precision over the disguised
   and loose ones is PRECISION; a kind that never reaches it adds nothing.
4. Proposals that overlap a base span go. Of the others over their thresholds the best scored one is added, then the best
   of those that overlap no added one, and so on until none is left.

All positions are code points. Patterns use possessive loops and look-behinds, so long runs take linear time and no stack.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stored, whole_texts

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, in order of KINDS, written so that they match the same spans in linear time.
BASE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: Looser proposals: (kind, pattern, what a text must contain to be searched).
LOOSE = (
    (0, r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|@)\x20?[a-z0-9-]{1,63}+"
        r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[a-z0-9-]{2,24}+){1,4}", r"(?i)[\[(]at[\])]|@"),
    (1, r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])", r":[0-9A-Fa-f]{1,4}:"),
    (2, r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}+(?![0-9])", r"[0-9][\x20.-]?[0-9]{3}"),
    (3, r"(?<![0-9+])(?:\(0?[0-9]{2,4}\)|0[0-9]{2,4}|[0-9]{3})[\x20./-][0-9]{3,4}[\x20./-]?[0-9]{3,5}(?![0-9])",
     r"[0-9][\x20./)-]+[0-9]{3}"),
)
#: Cheap tests before the base patterns are run.
NEEDS = ("@", r"[0-9]\.[0-9]", r"[0-9][\x20-]?[0-9]", r"\+[0-9]")
GENERATORS = [(k, p, n) for k, (p, n) in enumerate(zip(BASE, NEEDS))] + [(k, p, n) for k, p, n in LOOSE]
CONTEXT = 24
#: Number and depth of the trees; precision that an added span's kind must reach.
TREES, DEPTH, PRECISION = 10, 4, 0.98


def _found(text: Column, generator: int) -> Column:
    """Array of (gap, match, left, right) of a generator's matches: one split and one extraction per text."""
    _, pattern, _ = GENERATORS[generator]
    both = F.array(F.struct(F.split(text, pattern, -1).alias("gaps"),
                            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches")))
    return F.transform(both, lambda b: F.transform(b["matches"], lambda m, i: F.struct(
        F.lit(generator).alias("generator"), i.alias("i"), F.char_length(F.get(b["gaps"], i)).alias("gap"),
        m.alias("match"), F.right(F.get(b["gaps"], i), F.lit(CONTEXT)).alias("left"),
        F.left(F.get(b["gaps"], i + 1), F.lit(CONTEXT)).alias("right"))))[0]


def proposals(rows: DataFrame) -> DataFrame:
    """row, kind, generator, start, end, match, left, right, base: every proposal, placed in its text.

    rows: row and found (array of what _found gives). Positions are running sums per row and generator.
    """
    exploded = rows.select("row", F.inline("found"))
    seen = Window.partitionBy("row", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("match").cast("long")
    placed = exploded.withColumn("end", F.sum(F.col("gap") + size).over(seen)).withColumn("start", F.col("end") - size)
    kind = F.array(*[F.lit(k) for k, _, _ in GENERATORS])[F.col("generator")]
    return placed.withColumn("kind", kind).withColumn("base", _passes())


def _digits(column: str = "match") -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def _passes() -> Column:
    """Whether a strict generator's match passes the check of its kind; false for the looser generators."""
    octet = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
    count = F.length(_digits())
    card = count.between(16, 19) & F.call_function("luhn_check", F.when(count.between(16, 19), _digits()).otherwise("0"))
    return (F.when(F.col("generator") == 0, True)
            .when(F.col("generator") == 1, F.col("match").rlike(rf"^{octet}(?:\.{octet}){{3}}$"))
            .when(F.col("generator") == 2, card)
            .when(F.col("generator") == 3, count.between(8, 15)).otherwise(False))


def _islands(frame: DataFrame, *keys: str) -> DataFrame:
    """A column island: proposals of a key that overlap, directly or over others, share it."""
    order = Window.partitionBy(*keys).orderBy("start", "end", "generator")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    new = (F.col("start") >= F.max("end").over(before)).cast("int")
    return (frame.withColumn("__new", F.coalesce(new, F.lit(1)))
            .withColumn("island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__new"))


def _overlap_base(candidates: DataFrame) -> DataFrame:
    """A column taken: whether a proposal that is no base span overlaps one of its row, of whatever kind.

    Of the base spans that start before the proposal ends, one overlaps it if the furthest end lies beyond its start.
    """
    order = Window.partitionBy("row").orderBy("__at", "base").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (candidates.withColumn("__at", F.when(F.col("base"), F.col("start")).otherwise(F.col("end")))
            .withColumn("__reach", F.max(F.when(F.col("base"), F.col("end"))).over(order))
            .withColumn("taken", ~F.col("base") & F.coalesce(F.col("__reach") > F.col("start"), F.lit(False)))
            .drop("__at", "__reach"))


def _best_apart(scored: DataFrame) -> DataFrame:
    """row, kind, start, end, base: the best scored proposals that do not overlap, taken one after the other."""
    ranked = (_islands(scored, "row").groupBy("row", "island").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("cost"), "start", "end", "generator", "kind", "base"))).alias("ranked")))

    def add(chosen: Column, one: Column) -> Column:
        free = ~F.exists(chosen, lambda c: (c["start"] < one["end"]) & (one["start"] < c["end"]))
        return F.when(free, F.concat(chosen, F.array(one))).otherwise(chosen)

    chosen = F.aggregate("ranked", F.slice("ranked", 1, 0), add)
    return ranked.select("row", F.inline(chosen)).select("row", "kind", "start", "end", "base")


def with_features(frame: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context features of the proposals, as double columns."""
    match, left, right = F.col("match"), F.col("left"), F.col("right")
    digits = F.length(_digits())

    def share(text: Column, pattern: str) -> Column:
        return 1 - F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))

    made = {
        "f_length": F.length(match), "f_digits": digits, "f_digit_share": share(match, "[0-9]"),
        "f_letter_share": share(match, "[A-Za-z]"), "f_dots": F.length(match) - F.length(F.replace(match, F.lit("."))),
        "f_breaks": F.length(F.regexp_replace(match, r"[^\x20().-]", "")), "f_luhn": F.call_function("luhn_check", F.when(digits.between(2, 30), _digits()).otherwise("1")),
        "f_small_parts": ~match.rlike("[0-9]{4}"), "f_groups": F.size(F.split(match, "[^A-Za-z0-9]+")),
        "f_left_word": left.rlike(r"[A-Za-z0-9_]$"), "f_right_word": right.rlike(r"^[A-Za-z0-9_]"),
        "f_left_sign": left.rlike(r"""["'=:#/$]\x20?$"""), "f_right_sign": right.rlike(r"""^["'/%$]"""),
        "f_left_digits": share(left, "[0-9]"), "f_right_digits": share(right, "[0-9]"),
        "f_named": left.rlike(r"(?i)mail|phone|tel|call|fax|mobile|card|visa|ip|addr|contact"),
        "f_other": left.rlike(OTHER), "f_inside": left.rlike(INSIDE_LEFT) | right.rlike(INSIDE_RIGHT),
        **{f"f_kind_{k}": F.col("kind") == i for i, k in enumerate(KINDS)},
    }
    return frame.withColumns({name: c.cast("double") for name, c in made.items()}), list(made)


#: What names a number as something else right before it, and what makes a match part of a longer word or number.
OTHER = r"(?i)\b(?:token|key|hash|sha\d*|checksum|order|invoice|version|ver|serial|sku|isbn|ref|lot|page|batch|id|no)\b[\x20.:#=-]{0,3}$"
INSIDE_LEFT, INSIDE_RIGHT = r"[A-Za-z0-9_$%][.,/:-]?$", r"^[.,/:-]?[A-Za-z0-9_%]"


def examples(candidates: DataFrame) -> DataFrame:
    """Labelled examples: the columns of proposals, ``label`` and ``disguised`` (such that a loose generator may propose it).

    Every strict match gives one of its own and one in disguise; loose proposals give one where they are marked.
    """
    match, kind = F.col("match"), F.col("kind")
    email = F.regexp_replace(F.replace(match, F.lit("@"), F.lit(" [at] ")), r"\.(?=[^\x20]*$)", " [dot] ")
    parts = F.regexp_replace(match, r"^\+[0-9]{1,3}[\x20.-]*", "")
    phone = F.when(F.pmod("row", F.lit(2)) == 0, F.ltrim(F.regexp_replace(parts, r"[()\x20.-]+", "-"), F.lit("-"))).otherwise(parts)
    card = F.regexp_replace(_digits(), "([0-9]{4})(?=[0-9])", "$1.")
    disguise = (F.when(kind == 0, email).when((kind == 2) & (F.length(_digits()) >= 13), card)
                .when((kind == 3) & (F.length(_digits()) >= 8), phone))
    strict = candidates.filter(F.col("generator") < len(BASE)).withColumn("label", F.col("base").cast("double"))
    plain = strict.withColumn("disguised", F.lit(False))
    hidden = (strict.withColumns({"match": disguise, "generator": F.col("generator") + len(BASE), "disguised": F.lit(True)})
              .filter("match IS NOT NULL AND match <> ''"))
    marked = candidates.filter((F.col("generator") >= len(BASE)) & (
        F.col("left").rlike(OTHER) | F.col("left").rlike(INSIDE_LEFT) | F.col("right").rlike(INSIDE_RIGHT)))
    columns = ["row", "kind", "generator", "start", "match", "left", "right", "label", "disguised"]
    return (plain.select(columns).unionByName(hidden.select(columns))
            .unionByName(marked.withColumns({"label": F.lit(0.0), "disguised": F.lit(True)}).select(columns)))


def fit(candidates: DataFrame) -> tuple[GBTClassificationModel, list[float]] | None:
    """Boosted trees on three fourths of all examples, and a threshold per kind from the held-out fourth. None if the
    examples to learn from have one class only."""
    featured, names = with_features(examples(candidates).withColumn("h", F.xxhash64("match", "left", "right")))
    table = stored(featured.select("h", "kind", "label", "disguised", *names), "pii-examples")
    table = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    learn, held = table.filter(F.pmod("h", F.lit(4)) != 0), table.filter(F.pmod("h", F.lit(4)) == 0)
    if learn.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, maxMemoryInMB=64, checkpointInterval=-1).fit(learn)
    scored = model.transform(held.filter("disguised")).select("kind", "label", F.floor(_score() * 100).alias("level"))
    levels = scored.groupBy("kind", "level").agg(F.sum("label").alias("hits"), F.count("*").alias("all")).collect()
    thresholds = []
    for kind in range(len(KINDS)):
        own, hits, every, best = [r for r in levels if r["kind"] == kind], 0.0, 0, 2.0
        for r in sorted(own, key=lambda r: -r["level"]):
            hits, every = hits + r["hits"], every + r["all"]
            if hits >= PRECISION * every:
                best = r["level"] / 100
        thresholds.append(max(best, 0.5))
    return model, thresholds


def _score() -> Column:
    return vector_to_array("probability")[1]


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: documents (row, doc_id; one per row of ``docs``) and spans (row, kind, start, end, base).

    start and end count code points, end exclusive. Base spans are exactly the checked matches of the base patterns; the
    others are added by the trees and overlap no base span, nor each other. Null and empty texts have none; repeated rows and null doc_ids
    have a row each; other columns are ignored; an empty table gives two empty ones.
    """
    text = F.col("text")
    tests = [(text.contains(n) if n == "@" else text.rlike(n)) for _, _, n in GENERATORS]
    nothing = F.slice(_found(F.lit("0"), 0), 1, 0)
    found = F.concat(*[F.when(t, _found(text, g)).otherwise(nothing) for g, t in enumerate(tests)])
    rows = stored(whole_texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("found")),
                  "pii-found")
    candidates = stored(proposals(rows.filter(F.size("found") > 0)), "pii-proposals")
    base = candidates.filter("base").select("row", "kind", "start", "end", "base")
    fitted = fit(candidates)
    if fitted:
        model, thresholds = fitted
        featured, names = with_features(_overlap_base(candidates).filter("NOT base AND NOT taken"))
        assembled = VectorAssembler(inputCols=names, outputCol="features").transform(featured)
        limit = F.array(*[F.lit(t) for t in thresholds])[F.col("kind")]
        scored = model.transform(assembled).withColumn("score", _score()).filter(F.col("score") >= limit)
        base = base.unionByName(_best_apart(scored))
    return rows.select("row", "doc_id"), base


def documents_with_spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end, base>> by kind and start: one row per row of ``docs``."""
    rows, found = spans(docs)
    lists = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "base")))
                                     .alias("spans"))
    return rows.join(lists, "row", "left").select(
        "doc_id", F.coalesce("spans", F.expr("cast(array() AS array<struct<kind:int,start:bigint,end:bigint,base:boolean>>)"))
        .alias("spans"))


def span_text(spans_column: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
