"""Personal data by boosted trees over candidate spans, in DataFrame and SQL functions alone.

Generators propose spans, generously: four exact ones (the base kinds) and three loose ones,
whose spans overlap. Each candidate gets features of its format (lengths, digits, groups,
signs) and of its context (characters and words beside it), but none of the checks that make
a base span.
Gradient-boosted trees (Spark's own, in the JVM) learn from them which candidates are personal data:
those that are base spans are examples for it (as they are, and less the mark that their base
pattern wants), those that touch none against it. All of them count: equal examples are one row with their number
as its weight. For each kind the threshold is calibrated on candidates that the training leaves out, a fixed fourth: the least
score from which on the share of examples is high enough. Base spans are always reported;
candidates from their kind's threshold on are added where they touch no base span.

Positions come from splitting a text at the matches: a match starts after all pieces and
matches before it. The patterns are written so that Java's engine neither recurses nor tries a
run of characters twice.

Nulls and odd input: a null text is empty; a null identifier stays null; rows that repeat an
identifier are scanned each; with too few candidates of either sort nothing is added; an
empty table gives an empty result; other columns are not looked at. Positions are code
points, ends exclusive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.llm import common

KINDS = ("email", "ip", "card", "phone")

# The base patterns. \G lets a match follow the one before it, as the look-behind alone would not.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of candidates, and the kind that each proposes.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)"
    r"[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)*+",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}",
    "ip": r"[0-9]{1,5}(?:[.:][0-9]{1,5}){3,4}",
}
#: Words before a candidate that tell of a kind.
CUES = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|addr|server",
    "card": r"(?i)card|visa|credit|pay",
    "phone": r"(?i)phone|tel|call|fax|mobile",
}
#: Characters of context on either side.
CONTEXT = 24

FEATURES = (
    "length digits letters blanks dots dashes brackets ats groups longest_group first_digit before_letter before_digit "
    "after_letter after_digit line_start cue_email cue_ip cue_card cue_phone is_email is_phone is_ip"
).split()
PRECISION = 0.95
ROUNDS, DEPTH = 10, 3

PIECE = ("gap", "before", "lead")
SPAN = "struct<kind: string, start: bigint, end: bigint>"


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each match of each generator, and one for each text without any: row, doc_id, generator (1 base,
    0 loose), kind, at (number of the match), gap (length of text before it), match, before, after. Staged."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = []
    for base, patterns in ((1, BASE), (0, LOOSE)):
        for kind, pattern in patterns.items():
            pieces = F.transform(
                F.split(text, pattern, -1),
                lambda p: F.struct(
                    F.length(p).cast("long").alias("gap"),
                    F.right(p, F.lit(CONTEXT)).alias("before"),
                    F.left(p, F.lit(2)).alias("lead"),
                ),
            )
            hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
            each = F.zip_with(pieces, hits, lambda p, m: F.struct(*[p[c].alias(c) for c in PIECE], m.alias("match")))
            # Texts without a digit or an @ can have no match.
            here = F.contains(text, F.lit("@")) | F.contains(text, F.lit("(")) | F.contains(text, F.lit("["))
            here = here if kind == "email" else text.rlike("[0-9]")
            found.append(F.struct(F.lit(base).alias("base"), F.lit(kind).alias("kind"), F.when(here, each).alias("each")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.array(*found).alias("found"))
    rows = rows.select("row", "doc_id", F.explode("found").alias("f"))
    # The last piece has no match but follows the one before; a generator without a match leaves one row in all.
    rows = rows.filter((F.size("f.each") > 1) | ((F.col("f.base") == 1) & (F.col("f.kind") == KINDS[0])))
    rows = rows.select("row", "doc_id", "f.base", "f.kind", F.posexplode_outer("f.each").alias("at", "e"))
    return common.stage(rows.select("row", "doc_id", "base", "kind", "at", "e.*"), "matches")


def placed(found: DataFrame) -> DataFrame:
    """The matches with start and end, and the two characters after each."""
    order = Window.partitionBy("row", "base", "kind").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.coalesce(F.length("match"), F.lit(0)).cast("long")
    rows = found.filter("gap is not null").withColumn("end", F.sum(F.col("gap") + n).over(upto))
    rows = rows.withColumn("after", F.lead("lead").over(order))
    return rows.filter("match is not null").withColumn("start", F.col("end") - n)


def is_base(kind: Column, match: Column) -> Column:
    """Whether a match of a base pattern is a span of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    small = F.forall(
        F.split(match, r"\."),
        lambda p: F.coalesce(F.ltrim(p, F.lit("0")).rlike(r"^([0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"), F.lit(False)),
    )
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.length(digits).between(16, 19) & F.expr("luhn_check(regexp_replace(match, '[^0-9]', ''))"))
        .otherwise(F.length(digits).between(8, 15))
    )


def with_features(candidates: DataFrame) -> DataFrame:
    m, b, a = F.col("match"), F.col("before"), F.coalesce(F.col("after"), F.lit(""))
    count = lambda chars: F.length(F.regexp_replace(m, f"[^{chars}]", ""))
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: F.length(g) > 0)
    own = {
        "length": F.length(m),
        "digits": count("0-9"),
        "letters": count("A-Za-z"),
        "blanks": count(" "),
        "dots": count("."),
        "dashes": count("-"),
        "brackets": count("()"),
        "ats": count("@"),
        "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "first_digit": F.coalesce(F.regexp_extract(m, "([0-9])", 1).try_cast("int"), F.lit(-1)),
        "before_letter": b.rlike("[A-Za-z]$").cast("int"),
        "before_digit": b.rlike("[0-9][\x20.-]?$").cast("int"),
        "after_letter": a.rlike("^[A-Za-z]").cast("int"),
        "after_digit": a.rlike("^[\x20.-]?[0-9]").cast("int"),
        "line_start": b.rlike("(^|\n)$").cast("int"),
        **{f"cue_{k}": b.rlike(cue).cast("int") for k, cue in CUES.items()},
        **{f"is_{k}": (F.col("kind") == k).cast("int") for k in LOOSE},
    }
    return candidates.withColumns({k: own[k].cast("double") for k in FEATURES})


def touching(candidates: DataFrame, spans: DataFrame) -> DataFrame:
    """Candidates with `same` (a base span of its kind lies in it or around it) and `touches` (any overlaps it).

    Sweep over both by start: of the spans that start before a candidate's end, the furthest end tells
    whether one reaches into it. Linear in a text's spans, which no pair of them is built for.
    """
    c = candidates.select("row", F.col("end").alias("at"), F.lit(1).alias("ask"), "start", "end", "kind")
    s = spans.select(
        "row", F.col("start").alias("at"), F.lit(2).alias("ask"), F.col("start"), F.col("end"), "kind"
    )
    # At equal places a candidate's end comes first: a span that starts there doesn't overlap it.
    so_far = Window.partitionBy("row").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = c.unionByName(s)
    reach = lambda test: F.max(F.when((F.col("ask") == 2) & test, F.col("end"))).over(so_far)
    both = both.withColumn("any", reach(F.lit(True)))
    both = both.withColumns({f"of_{k}": reach(F.col("kind") == k) for k in KINDS})
    own = F.coalesce(*[F.when(F.col("kind") == k, F.col(f"of_{k}")) for k in KINDS])
    both = both.filter("ask = 1")
    both = both.withColumn("touches", F.coalesce(F.col("any") > F.col("start"), F.lit(False)))
    both = both.withColumn("same", F.coalesce(own > F.col("start"), F.lit(False)))
    return candidates.join(both.select("row", "kind", "start", "end", "touches", "same"), ["row", "kind", "start", "end"])


def without_marks(examples: DataFrame) -> DataFrame:
    """The examples once more without the mark by which the base pattern knows them: a number without its country's
    code, an address with its @ spelt out. Else the trees would learn that mark alone."""
    kind, match = F.col("kind"), F.col("match")
    plain = (
        F.when(kind == "phone", F.regexp_replace(match, r"^\+[0-9]{1,3}[\x20.-]?", ""))
        .when(kind == "email", F.regexp_replace(match, "@", " [at] "))
        .otherwise(match)
    )
    other = examples.withColumn("plain", plain).filter("plain <> match and length(plain) > 0")
    return with_features(other.withColumn("match", F.col("plain")).drop("plain", *FEATURES)).select(*examples.columns)


def examples_of(candidates: DataFrame) -> DataFrame:
    """All examples: kind, label, fold, the features, and n, the number of examples that are equal in all of these. Staged.
    Candidates of one match and context are in one fold."""
    examples = candidates.filter("same or not touches").withColumn("label", F.col("same").cast("double"))
    examples = examples.unionByName(without_marks(examples.filter("same")))
    fold = F.pmod(F.xxhash64("match", "before"), F.lit(4)).alias("fold")
    examples = examples.groupBy("kind", "label", fold, *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return common.stage(examples, "examples")


def train(candidates: DataFrame) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """The trees, and each kind's threshold; None if there are too few examples of either sort."""
    examples = examples_of(candidates)
    counts = {r.label: r.n for r in examples.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < 20:
        return None
    examples = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(examples).drop(*FEATURES)
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH, seed=7).fit(
        examples.filter("fold > 0")
    )
    held = model.transform(examples.filter("fold = 0"))
    score = F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("score")
    held = held.select("kind", F.expr("label * n").alias("good"), "n", score)
    thresholds = {}
    rows = held.groupBy("kind", "score").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect()
    for kind in LOOSE:  # at most 101 rows for each kind
        own = sorted(((r.score, r.good, r.n) for r in rows if r.kind == kind), reverse=True)
        good = n = 0
        for score, g, k in own:
            good, n = good + g, n + k
            if good >= PRECISION * n:
                thresholds[kind] = score / 100
    return model, thresholds


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: doc_id, base and added (arrays of spans: kind, start, end)."""
    found = matches(docs, id_col, text_col)
    spots = common.stage(placed(found), "places")
    base = spots.filter("base = 1").filter(is_base(F.col("kind"), F.col("match")))
    span = F.struct("kind", "start", "end")
    out = found.select("row", "doc_id").distinct()
    out = out.join(base.groupBy("row").agg(F.collect_list(span).alias("base")), "row", "left")

    candidates = common.stage(with_features(touching(spots.filter("base = 0"), base)), "candidates")
    trained = train(candidates)
    none = F.array().cast(f"array<{SPAN}>")
    if trained is None:
        return out.select("doc_id", F.coalesce("base", none).alias("base"), none.alias("added"))
    model, thresholds = trained
    bar = F.create_map(*[F.lit(x) for k in LOOSE for x in (k, thresholds.get(k, 2.0))])
    free = candidates.filter("not touches")
    scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(free))
    added = scored.filter(vector_to_array("probability")[1] >= bar[F.col("kind")])
    out = out.join(added.groupBy("row").agg(F.collect_set(span).alias("added")), "row", "left")
    return out.select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, by kind as listed and then start."""
    place = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(place[s["kind"]].alias("o"), s["start"], s["end"], s["kind"]))
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document."""
    found = personal_data(common.documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
