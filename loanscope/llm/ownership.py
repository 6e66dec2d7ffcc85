"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base spans come from fixed patterns. Every candidate value (the assigned value, the access key, the hex run) is hashed,
and the distinct owners and repositories that have it are counted over the whole corpus: a value that more than
MAX_OWNERS owners or more than MAX_REPOSITORIES repositories have is a copied example, any other looks live. The method also takes bare candidates, runs of
16 or more key characters with a letter and a digit outside base spans; those that look live are added as `bare` spans.

Offsets count code points. They come from the texts between matches, whose lengths are added up per row. Copies of a
value are counted once per task and owner before they are shuffled. Null texts count as empty, a null owner or
repository as one of its own; repeated rows are rows of their own, and texts without spans have empty lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loanscope.llm.shared import whole, written

# Fixed patterns; (pattern, group of the value, least length of the value). Java's (?i) is ASCII only.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),  # a run is taken whole, so shorter ones need not be matched first
}
BARE = "[A-Za-z0-9+/_=-]{16,}+"  # whether there is a digit is asked afterwards: looking ahead costs the square of a run
KINDS = (*PATTERNS, "bare")
MAX_OWNERS = 2
MAX_REPOSITORIES = 10


def _found(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """A row for each row of `docs` with its matches and the lengths of the texts before them, numbered for good."""
    patterns = {k: (p, g) for k, (p, g, _) in PATTERNS.items()} | {"bare": (BARE, 0)}
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"), whole(text).alias("t"),
    )
    for k, (p, _) in patterns.items():
        rows = rows.withColumn(f"m_{k}", F.regexp_extract_all("t", F.lit(p), F.lit(0)))

    def matches(k: str):
        p, g = patterns[k]
        gaps = F.transform(F.split("t", p, -1), F.char_length)
        values = F.col(f"m_{k}") if not g else F.regexp_extract_all("t", F.lit(p), F.lit(g))
        zipped = F.arrays_zip(gaps.alias("gap"), F.transform(F.col(f"m_{k}"), F.char_length).alias("size"), values.alias("value"))
        return F.when(F.size(f"m_{k}") > 0, zipped).alias(k)

    return written(rows.select("doc_id", "owner", "repository", *(matches(k) for k in KINDS)).withColumn("row", F.monotonically_increasing_id()))


def _spans(found: DataFrame) -> DataFrame:
    """(row, owner, repository, kind, start, end, value) of all matches that are long enough."""
    every = None
    for n, k in enumerate(KINDS):
        names = [f.name for f in found.schema[k].dataType.elementType.fields]
        one = found.filter(F.col(k).isNotNull()).select("row", "owner", "repository", F.posexplode(k).alias("nth", "m")).select(
            "row", "owner", "repository", F.lit(n).alias("kind"), "nth",
            *(F.col(f"m.`{name}`").alias(new) for name, new in zip(names, ("gap", "size", "value"))),
        )
        every = one if every is None else every.unionAll(one)
    upto = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(
        Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    least = F.element_at(F.array(*(F.lit(PATTERNS[k][2] if k in PATTERNS else 0) for k in KINDS)), F.col("kind") + 1)
    spans = every.withColumn("end", upto).filter("size is not null").filter(F.char_length("value") >= least)
    return spans.withColumn("start", F.col("end") - F.col("size")).select("row", "owner", "repository", "kind", "start", "end", "value")


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, owners, repositories): how many distinct ones have each candidate value."""
    each = spans.groupBy("digest", "owner", "repository").agg(F.count(F.lit(1)).alias("spans"))
    by_owner = each.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("pairs"))
    owners = by_owner.groupBy("digest").agg(F.count(F.lit(1)).alias("owners"))
    repositories = each.groupBy("digest", "repository").agg(F.count(F.lit(1)).alias("pairs")).groupBy("digest")
    return owners.join(repositories.agg(F.count(F.lit(1)).alias("repositories")), "digest")


def _joined(spans, sep: str = ","):
    """kind:start:end of an array of (start, kind, end) in its order."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), sep)


def secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans; n_live, n_copied and the live spans besides."""
    found = _found(docs, key, text, owner, repository)
    spans = written(_spans(found).withColumn("digest", F.sha2("value", 256)))
    bare = len(KINDS) - 1
    base = spans.filter(F.col("kind") < bare)
    near = base.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    b = spans.filter((F.col("kind") == bare) & F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]"))
    b = b.join(near, (F.col("row") == F.col("r")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_anti")
    candidates = written(base.unionAll(b))
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    judged = candidates.join(ownership(candidates), "digest").withColumn("live", few)
    judged = judged.filter((F.col("kind") < bare) | F.col("live"))
    parts = judged.groupBy("row").agg(
        *(F.count_if(F.col("kind") == n).alias(f"n_{k}") for n, k in enumerate(KINDS)),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"),
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("all"),
    )
    none = F.from_json(F.lit("[]"), parts.schema["all"].dataType)
    rows = found.select("row", "doc_id").join(parts, "row", "left").withColumn("all", F.coalesce("all", none))
    return rows.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in PATTERNS),
        F.sha2(_joined(F.filter("all", lambda s: s["kind"] < bare)), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_bare", "n_live", "n_copied")),
        _joined(F.filter("all", lambda s: s["live"])).alias("live_spans"),
    )
