"""Personal data: wide generators, boosted trees on format and context, calibrated cut.

Generators propose spans of four kinds; those that meet the kind's fixed rules are
base spans and stay. Wider proposals (grouped national numbers, spelled-out mail
addresses) and base forms that fail their rules are scored by gradient-boosted trees
on their format and the words before them. No base span is such a proposal, so the
labels come from elsewhere: positives are all base mail addresses and phone numbers,
rewritten into wide forms where they stand; negatives are rewrites
with a digit group or a following sentence too many or too few, base forms that
failed, and digit groups inside IPs and cards. ``SEEDS`` invented mails and phones are rewritten
too, so a corpus with few base spans is also taught. Every labelled row counts: rows of
equal features are one row with their number as weight, so what the trees read grows
with the variety of forms, not with the corpus. Other wide proposals have no label and
are only scored. The lowest score whose precision on held-out labelled
rows is at least ``precision`` is the threshold; proposals above it that lie in no
base span are added as kind ``other``.

Null texts count as empty. Repeated rows give repeated results; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.llm.base import table, whole_text
from pathkin.llm.spans import SPAN, count, in_order, joined, matches, together
from pathkin.session import stage as written

# fixed values: the base kinds' patterns; a start inside a run can't match where the run's start doesn't
EMAIL = (
    "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
)
IP = "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?:[\\x20-]?[0-9]){13,}+"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
# wider forms
LOCAL = "(?:\\G|(?<![A-Za-z0-9._+-]))[A-Za-z0-9._+-]{2,}+\\x20?[\\[(](?i:at)[\\])]\\x20?[A-Za-z0-9-]{2,63}"
SPELLED = LOCAL + "(?:\\x20?(?:\\.|[\\[(](?i:dot)[\\])])\\x20?[A-Za-z]{2,24})++"
# the same without what may be the next sentence
BREAK = "(?:\\.|\\x20\\.\\x20|\\x20?[\\[(](?i:dot)[\\])]\\x20?)"
CLOSE = f"{LOCAL}(?:{BREAK}[A-Za-z0-9-]{{1,63}})*{BREAK}[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
DIGITS = "(?<![0-9A-Za-z.+])\\(?[0-9]{3}\\)?[\\x20.-]?[0-9]{2,4}[\\x20.-][0-9]{3,4}(?![0-9A-Za-z])"
KINDS = ["email", "ip", "card", "phone", "other"]
CONTEXT = "(?i)(?:phone|tel|call|mail|card|ip|contact|ssn|iban)[^A-Za-z0-9]{0,3}$"
FEATURES = [
    "n", "digits", "letters", "dots", "blanks", "hyphens", "plus", "at_sign", "brackets", "squares", "tail", "dot_gap",
    "inside", "context",
]
SEEDS = 400


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: Column) -> Column:
    n = lambda s: F.length(_digits(s["value"]))
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return together(
        [
            matches(text, "email", EMAIL),
            F.filter(matches(text, "ip", IP), lambda s: s["value"].rlike(f"^{part}(?:\\.{part}){{3}}$")),
            F.filter(matches(text, "card", CARD), lambda s: n(s).between(14, 19) & luhn(s["value"])),
            F.filter(matches(text, "phone", PHONE), lambda s: n(s).between(10, 15)),
        ]
    )


def proposals(text: Column) -> Column:
    """Wide, possibly overlapping spans; base forms have their own kind."""
    return together(
        [
            matches(text, "email", EMAIL),
            matches(text, "ip", IP),
            matches(text, "card", CARD),
            matches(text, "phone", PHONE),
            matches(text, "other", SPELLED),
            matches(text, "other", CLOSE),
            matches(text, "other", DIGITS),
        ]
    )


def with_features(rows: DataFrame) -> DataFrame:
    """``rows`` has value, before and inside."""
    value = F.col("value")
    many = lambda cls: F.length(F.regexp_replace(value, f"[^{cls}]", "")).cast("double")
    return rows.select(
        "*",
        F.length(value).cast("double").alias("n"),
        many("0-9").alias("digits"),
        many("A-Za-z").alias("letters"),
        many(".").alias("dots"),
        many("\\x20").alias("blanks"),
        many("-").alias("hyphens"),
        many("+").alias("plus"),
        many("@").alias("at_sign"),
        many("()").alias("brackets"),
        many("\\[\\]").alias("squares"),
        F.length(F.regexp_extract(value, "[0-9]*$", 0)).cast("double").alias("tail"),
        value.rlike("[^\\x20]\\.\\x20[A-Za-z]").cast("double").alias("dot_gap"),
        F.col("before").rlike(CONTEXT).cast("double").alias("context"),
    )


def proposal_rows(found: DataFrame) -> DataFrame:
    """One row for each proposal, whether it is a base span, and its label where it has one."""
    rows = found.where(F.size("wide_") > 0).select("row_", F.explode("wide_").alias("x"), "base_", "wide_")
    kind, at, end = F.col("x.s.kind"), F.col("x.s.at"), F.col("x.s.end")
    inside = F.exists(
        "wide_",
        lambda w: w["s"]["kind"].isin("ip", "card") & (w["s"]["at"] < end) & (at < w["s"]["end"])
        & ((w["s"]["at"] != at) | (w["s"]["end"] != end)),
    )
    return rows.select(
        "row_",
        F.col("x.s").withField("kind", F.lit("other")).alias("s"),
        F.col("x.s.value").alias("value"),
        F.col("x.before").alias("before"),
        kind.alias("form"),
        inside.cast("double").alias("inside"),
        F.exists("base_", lambda b: (b["at"] == at) & (b["end"] == end)).alias("is_base"),
        F.exists("base_", lambda b: (b["at"] < end) & (at < b["end"])).alias("covered"),
    ).withColumn("label", F.when(~F.col("is_base") & ((F.col("form") != "other") | (F.col("inside") > 0)), 0.0))


def seeds(spark: SparkSession) -> DataFrame:
    """Invented mails and phones with a plus, half after a contact word."""
    pick = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    some = lambda k, xs: F.element_at(F.array(*map(F.lit, xs)), (pick(k, len(xs)) + 1).cast("int"))
    three = lambda k: F.lpad(pick(k, 1000).cast("string"), 3, "0")
    mail = F.concat(
        some(1, ["jo", "ann", "kim.lee", "info", "m_roth", "sales-team", "a.very.long.name"]), some(2, ["", "", "7", "52"]),
        F.lit("@"), some(3, ["site", "mail2", "my-shop", "uni", "example"]), some(4, [".com", ".de", ".org", ".co.uk", ".example"]),
    )
    phone = F.concat(F.lit("+1 ("), three(5), F.lit(") "), three(6), F.lit("-"), F.lpad(pick(7, 10_000).cast("string"), 4, "0"))
    return spark.range(SEEDS).select(
        (-1 - F.col("id")).alias("row_"),
        F.when(pick(8, 2) == 0, mail).otherwise(phone).alias("value"),
        some(9, ["", "see this ", "und dann ", "call ", "tel: ", "mail: ", "contact "]).alias("before"),
        F.when(pick(8, 2) == 0, "email").otherwise("phone").alias("form"),
    )


def rewrites(rows: DataFrame) -> DataFrame:
    """Base mails and phones (row_, value, before, form) as wide forms, and as forms near them that are neither."""
    value = F.col("value")
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    d = F.right(_digits(value), F.lit(10))
    a, b, c = F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    dots = lambda by: F.replace(domain, F.lit("."), F.lit(by))
    mails = [
        text(local, " [at] ", dots(" [dot] ")), text(local, "(at)", dots("(dot)")), text(local, " (at) ", domain),
        text(local, "[at]", domain), text(local, " [AT] ", dots(" (DOT) ")), text(local, " (at) ", dots(" . ")),
    ]
    sentences = [
        text(local, " (at) ", domain, ". Then"), text(local, " [at] ", dots(" [dot] "), ". De"),
        text(local, "(at)", F.substring_index(domain, ".", 1), ". the"),
    ]
    phones = [
        text("(", a, ") ", b, "-", c), text(a, "-", b, "-", c), text(a, ".", b, ".", c), text(a, " ", b, " ", c),
        text("(", a, ")", b, "-", c), text("(", a, ") ", b, " ", c), text(a, " ", b, "-", c), text(a, b, "-", c),
        text("0", F.substring(d, 1, 2), "-", F.substring(d, 3, 4), "-", c),
        text("0", F.substring(d, 1, 2), " ", F.substring(d, 3, 4), " ", c),
    ]
    others = [
        text("(", a, ") ", b, "-", F.left(c, F.lit(3))), text(a, "-", b, "-", F.left(c, F.lit(3))), text(a, ".", b, ".", F.left(c, F.lit(3))),
        text(a, " ", b, " ", F.left(c, F.lit(3))), text(a, "-", F.left(b, F.lit(2)), "-", c), text(a, F.left(b, F.lit(2)), "-", c),
        text(a, "-", F.substring(d, 4, 4), "-", F.right(d, F.lit(3))), text(a, F.left(b, F.lit(2)), " ", F.left(c, F.lit(3))),
        # as base forms that fail their rules
        text(d, F.left(d, F.lit(6))), text(a, "0 ", b, "1 ", c, " ", c), text(a, ".", b, ".300.", a),
        text("+1 (", a, ") ", b, "-", F.left(c, F.lit(2))),
    ]
    as_rows = lambda xs, label: F.transform(F.array(*xs), lambda x: F.struct(x.alias("value"), F.lit(label).alias("label")))
    made = F.when(F.col("form") == "email", F.concat(as_rows(mails, 1.0), as_rows(sentences, 0.0))).otherwise(
        F.concat(as_rows(phones, 1.0), as_rows(others, 0.0))
    )
    return rows.select("row_", "before", F.explode(made).alias("m")).select(
        "row_", "before", F.lit(0.0).alias("inside"), "m.value", "m.label"
    )


def threshold(scored: DataFrame, precision: float, bins: int = 100) -> float:
    """Lowest score from which the share of positives is at least ``precision``; above 1 if none.

    A row stands for ``n_rows`` rows.
    """
    rows = (
        scored.groupBy(F.floor(F.col("p") * bins).alias("bin"))
        .agg(F.sum(F.col("label") * F.col("n_rows")).alias("good"), F.sum("n_rows").alias("n"))
        .orderBy(F.desc("bin"))
        .collect()  # at most bins + 1 rows
    )
    good = n = 0.0
    best = 2.0
    for r in rows:
        good, n = good + r.good, n + r.n
        if good / n >= precision:
            best = r.bin / bins
    return best


def scan(docs: DataFrame, precision: float = 0.99) -> DataFrame:
    """doc_id, base spans and all spans of every row."""
    text = F.col("text")
    docs = docs.select(docs["doc_id"], whole_text(docs).alias("text"))
    with_before = F.transform(
        proposals(text),
        lambda s: F.struct(
            s.alias("s"),
            F.substring(text, F.greatest(s["at"] - 15, F.lit(1)), F.least(s["at"], F.lit(16))).alias("before"),
        ),
    )
    found = written(
        docs.select("doc_id", base_spans(text).alias("base_"), with_before.alias("wide_")).withColumn(
            "row_", F.monotonically_increasing_id()
        ),
        "pii",
    )
    rows = proposal_rows(found)
    labelled = rows.where("label is not null").select("row_", "before", "inside", "value", "label")
    told = rows.where("is_base and form in ('email', 'phone')").select("row_", "value", "before", "form")
    made = rewrites(told.unionByName(seeds(docs.sparkSession)))
    held = F.pmod(F.xxhash64("row_", *FEATURES), F.lit(4)) == 0
    taught = (
        with_features(labelled.unionByName(made))
        .groupBy(held.alias("held"), "label", *FEATURES)
        .agg(F.count("*").cast("double").alias("n_rows"))
    )
    taught = written(taught, "pii-taught")
    base = in_order(F.col("base_"), KINDS)
    nothing = F.array().cast(SPAN)
    join_features = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxDepth=4, maxIter=12, seed=3, weightCol="n_rows")
    model = trees.fit(join_features.transform(taught.where("not held")))
    score = lambda d: model.transform(join_features.transform(d)).withColumn(
        "p", vector_to_array("probability")[1]
    )
    cut = threshold(score(taught.where("held")), precision)
    extra = (
        score(with_features(rows.where(~F.col("covered")).drop("label")))
        .where(F.col("p") >= cut)
        .groupBy("row_")
        .agg(F.collect_set("s").alias("extra_"))
    )
    return (
        found.select("row_", "doc_id", base.alias("base_"))
        .join(extra, "row_", "left")
        .select(
            "doc_id",
            "base_",
            in_order(F.concat("base_", F.coalesce("extra_", nothing)), KINDS).alias("spans_"),
        )
    )


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[count(F.col("base_"), k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(joined(F.col("base_")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans_")).alias("spans"),
    )
