"""Secrets by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the base kinds (assign, access, hex) and wider forms of known keys.
Their hashes are counted over distinct repositories and owners of the whole corpus,
where a text that stands in several places counts once, with its least owner and
repository: copying a document does not make its keys examples. A candidate is an
example if it has more than ``max_owners`` owners and more than ``max_repositories``
repositories (two and three: a text slightly changed elsewhere is still one leak);
one that is no example and looks random is "live". Base spans always stay; a wide candidate that
is live and lies in no base span adds a span of kind ``live``.

Documents have no repository column: the owner is ``source`` and the repository is
``source`` with ``lang``. Nulls count as one unnamed owner. Null texts count as
empty. Repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.llm.base import DOC_COLUMNS, table, whole_text
from pathkin.llm.spans import count, in_order, joined, matches, redacted, together
from pathkin.session import stage as written

# fixed values: the base kinds' patterns; possessive where nothing can be given back
ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]++)"
)
ACCESS = "AKIA[A-Z0-9]{12,}+"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}+"
# fixed values: public key formats
WIDE = (
    "(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}+|sk_live_[A-Za-z0-9]{16,}+|xox[baprs]-[A-Za-z0-9-]{20,}+"
    "|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{16,}+\\.[A-Za-z0-9_-]{16,}+\\.[A-Za-z0-9_-]{16,}+)"
)
KINDS = ["assign", "access", "hex", "live"]


def candidates(text: Column) -> Column:
    assign = F.filter(matches(text, "assign", ASSIGN, 2), lambda s: F.length(s["inner"]) >= 8)
    return together(
        [assign, matches(text, "access", ACCESS), matches(text, "hex", HEX), matches(text, "live", WIDE)]
    )


def looks_random(value: Column) -> Column:
    """Digits and letters mixed, and many different characters."""
    kinds = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (kinds >= 8)


def scan(
    docs: DataFrame, keep: list[str], owner: Column, repository: Column, max_owners: int = 2, max_repositories: int = 3
) -> DataFrame:
    """``keep`` columns, base spans, all spans, the number of live and shared candidates, and the counts of each."""
    docs = docs.withColumn("text", whole_text(docs))
    found = written(
        docs.select(
            *keep,
            F.coalesce(owner.cast("string"), F.lit("")).alias("owner_"),
            F.coalesce(repository.cast("string"), F.lit("")).alias("repository_"),
            F.sha2(F.col("text").cast("binary"), 256).alias("text_"),
            candidates(F.col("text")).alias("found_"),
        ).withColumn("row_", F.monotonically_increasing_id()),
        "secrets",
    )
    some = (
        found.where(F.size("found_") > 0)
        .select("row_", "text_", "owner_", "repository_", F.explode("found_").alias("s"))
        .withColumn("hash", F.sha2(F.col("s.inner"), 256))
    )
    spread = (
        # every copy of a text has the same candidates, so this is the text's least owner for all of them
        some.groupBy("hash", "text_").agg(F.min(F.struct("owner_", "repository_")).alias("first"))
        .groupBy("hash", "first.owner_", "first.repository_").agg(F.count("*").alias("n"))
        .groupBy("hash", "owner_").agg(F.count("*").alias("repositories"))
        .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    judged = some.join(spread, "hash").select(
        "row_", "s", "owners", "repositories",
        (
            ((F.col("owners") <= max_owners) | (F.col("repositories") <= max_repositories))
            & looks_random(F.col("s.inner"))
        ).alias("live"),
    )
    by_row = judged.groupBy("row_").agg(
        F.collect_list(F.when(F.col("live"), F.col("s"))).alias("live_"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_shared"),
        F.collect_list(
            F.struct("s.at", "s.end", "s.kind", "owners", "repositories")
        ).alias("spread_"),
    )
    base = in_order(F.filter("found_", lambda s: s["kind"] != "live"), KINDS)
    # a row without candidates has nothing to meet, so its text is not shuffled
    some_found = found.where(F.size("found_") > 0).join(by_row, "row_", "left")
    out = some_found.unionByName(found.where(F.size("found_") <= 0), allowMissingColumns=True).withColumn("base_", base)
    extra = F.filter(
        F.coalesce("live_", F.filter("base_", lambda s: F.lit(False))),
        lambda s: (s["kind"] == "live")
        & ~F.exists("base_", lambda b: (b["at"] < s["end"]) & (s["at"] < b["end"])),
    )
    return out.withColumn("spans_", in_order(F.concat("base_", extra), KINDS)).select(
        *keep, "base_", "spans_",
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_shared", F.lit(0)).alias("n_shared"),
        F.array_sort("spread_").alias("spread_"),
    )


def _owner(docs: DataFrame) -> tuple[Column, Column]:
    return docs["source"], F.concat_ws("/", docs["source"], docs["lang"])


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, ["doc_id"], *_owner(docs))
    return found.select(
        "doc_id",
        *[count(F.col("base_"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.col("base_")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans_")).alias("spans"),
        "n_live",
        "n_shared",
        # kind:start:end:owners:repositories of every candidate, by place
        F.coalesce(
            F.array_join(
                F.transform("spread_", lambda c: F.concat_ws(":", c["kind"], c["at"], c["end"], c["owners"], c["repositories"])), ","
            ),
            F.lit(""),
        ).alias("ownership"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays; all spans are replaced in its text."""
    found = scan(docs, DOC_COLUMNS, *_owner(docs))
    text = redacted(F.col("text"), F.col("spans_"), "[secret]")
    return (
        found.select("doc_id", text.alias("text"), "lang", "source")
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*DOC_COLUMNS)
    )
