"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Three kinds of spans come from patterns alone: ``assign`` (a password-like name, a sign, a value of eight
characters or more), ``access`` (``AKIA...``) and ``hex``. A fourth, ``owned``, needs the whole corpus: runs of
20 or more token characters that look alive (letters and digits, ten different characters) are candidates,
and so is the value of every other span (what is assigned, or the whole match), whatever its length. The hashes
of all candidates are aggregated by distinct repositories and owners, a value being one candidate however it
was found. A candidate that more than ``max_owners`` owners share is a widely copied example. Of the others, one in at most
``max_repos`` repositories is somebody's own credential (``owned``), however often a repository repeats it; one in
more is a class of its own (``spread``): a live credential that its owner has copied about, or an example that one owner
uses throughout. Long runs of these two classes become spans, those of examples are only counted; the spans of the three
patterns stay either way and carry the verdict.

Texts are read once; what is shuffled are matches and one narrow row per document. Counts are aggregated
before they are shuffled, by (hash, repository) and (hash, owner), so that an example in a third of all
documents is spread over tasks.

Defined results: a null text is an empty one; repeated rows each give their row; null owners count as one
owner, null repositories as one repository; rows without id have theirs; an empty table gives no rows; texts
of any length are scanned whole. Places count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topicflow.llm.common import materialize

KINDS = ["assign", "access", "hex", "owned", "spread"]
OWNED, SPREAD, EXAMPLE = "owned", "spread", "example"

# The patterns of the contract; (?i:) covers ASCII letters only. Where a shortest length is in
# the pattern itself, shorter runs can't hold another match.
PATTERNS = [
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"AKIA[A-Z0-9]{12,}",
    r"(?<![0-9a-f])[0-9a-f]{32,}+",
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
]


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches, each with the number of characters between it and the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    return F.when(F.regexp_like(text, F.lit(pattern)), F.zip_with(
        F.slice(between, 1, F.size(found)), found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("match"))))


def _of_kind(kind: int, matches: Column) -> Column:
    return F.transform(F.coalesce(matches, F.array()), lambda m: F.struct(
        F.lit(kind).alias("kind"), m.gap.alias("gap"), m.match.alias("match")))


def _alive(match: Column) -> Column:
    kinds = [F.length(match) - F.length(F.regexp_replace(match, c, "")) for c in ("[0-9]", "[A-Za-z]")]
    return (kinds[0] >= 3) & (kinds[1] >= 3) & (F.size(F.array_distinct(F.split(match, ""))) >= 10)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "doc_id", max_owners: int = 2, max_repos: int = 10) -> DataFrame:
    """Per row of ``docs``: the id column, ``spans`` (array of start, kind, end, the value's owners and repos and its
    ``verdict``; by start, then kind), and ``n_examples`` (long runs that are widely copied)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"),
                      F.col(repo_col).cast("string").alias("repo"),
                      *[_matches(text, p).alias(k) for k, p in zip(KINDS[:4], PATTERNS)])
    own = materialize(own).withColumn("row", F.monotonically_increasing_id())
    listed = F.concat(*[_of_kind(i, F.col(k)) for i, k in enumerate(KINDS[:4])])
    found = own.select("row", "owner", "repo", F.posexplode(listed).alias("turn", "m")).select(
        "row", "owner", "repo", "turn", "m.*")
    place = F.sum(F.col("gap") + F.length("match")).over(W.partitionBy("row", "kind").orderBy("turn"))
    found = found.withColumn("end", place).withColumn("start", F.col("end") - F.length("match"))
    value = F.regexp_extract("match", PATTERNS[0], 2)
    found = found.where(F.when(F.col("kind") == 0, F.length(value) >= 8)
                        .when(F.col("kind") == 3, _alive(F.col("match"))).otherwise(True))
    value = F.when(F.col("kind") == 0, value).otherwise(F.col("match"))
    found = found.withColumns({"h1": F.xxhash64(value), "h2": F.xxhash64(F.lit(1), value)})

    candidates = found.withColumns({c: F.coalesce(c, F.lit("")) for c in ("owner", "repo")})
    spread = candidates.groupBy("h1", "h2").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"))
    verdict = F.when(F.col("owners") > max_owners, EXAMPLE).when(F.col("repos") > max_repos, SPREAD).otherwise(OWNED)
    judged = candidates.join(spread, ["h1", "h2"]).withColumn("verdict", verdict)
    judged = judged.withColumn("kind", F.when((F.col("kind") == 3) & (F.col("verdict") == SPREAD), 4).otherwise(F.col("kind")))
    span = (F.col("verdict") != EXAMPLE) | (F.col("kind") < 3)
    by_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(span, F.struct("start", "kind", "end", "owners", "repos", "verdict"))))
        .alias("spans"),
        F.count_if(~span).alias("n_examples"))
    return own.select("row", "id").join(by_row, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("spans", F.expr("array()")).alias("spans"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")
