"""Secrets in documents, and whose they are.

Three patterns give the base spans: assignments to names such as ``password``, access keys, and long runs of hex digits.
Every value found is counted over the corpus: in how many distinct repositories, and of how many distinct owners. Values
of many owners, or in very many repositories even of one owner, are copied examples; the others are live if they look
random. Long mixed tokens next to nothing telling are spans too, of kind ``bare``, if they are live and no base span covers
them. Owners and repositories are columns, and a repository may be a distinct text, as in ``documents``, where the owner is
the ``source``. If both are one column, both counts are equal and only the owners decide.

A text is scanned once; what is found, and no text, goes on. All of it is built-in functions. Places are code points,
ends exclusive. Null texts are empty. Null owners and repositories count as one of their own. Repeated rows are rows of
their own. An empty table gives no rows. Columns other than those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored, whole_text
from clickloom.llm.expressions import let

#: The base kinds in order: pattern, group that is the value, and the fewest characters of the value. Fixed values.
KINDS = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),  # runs are taken whole, so shorter ones need not be matched
}
#: Long tokens of three kinds of characters.
BARE = "bare"
BARE_PATTERN = r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+-]*+[0-9])(?=[a-z0-9_+-]*+[A-Z])(?=[A-Z0-9_+-]*+[a-z])[A-Za-z0-9_+-]{20,}+"
#: A text without any of these in small letters has no assignment.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
#: From so many owners on a value is a copied example.
COPIED_OWNERS = 3
#: From so many repositories on it is one too, whoever owns them.
COPIED_REPOSITORIES = 10
#: Different characters of a value that looks random.
RANDOM_CHARACTERS = 8
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|1234567"
#: Copies of a value's counts, so that the documents that hold one value do not all meet in one task.
SALTS = 16


def matches(text: Column, pattern: str, group: int, hint: Column) -> Column:
    """The matches of a pattern with the number of characters before each since the last one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
    each = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match"), values.alias("value"))
    kind = "array<struct<gap:int,match:string,value:string>>"
    return F.when(hint, each.cast(kind)).otherwise(F.array().cast(kind))


def scan(documents: DataFrame, owner: str, repository: str | None) -> DataFrame:
    """A row per document with an id of its own and the matches of each kind."""
    own = F.sha2(whole_text(), 256) if repository is None else F.col(repository).cast("string")
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        own.alias("repository"),
        whole_text().alias("text"),
    )
    small = F.lower("text")
    hints = {
        "assign": let(small, lambda t: F.expr("false") | _any(*[F.contains(t, F.lit(h)) for h in ASSIGN_HINTS])),
        "access": F.contains("text", F.lit("AKIA")),
        "hex": F.col("text").rlike(KINDS["hex"][0]),
    }
    columns = [matches(F.col("text"), p, group, hints[kind]).alias(kind) for kind, (p, group, _) in KINDS.items()]
    columns.append(matches(F.col("text"), BARE_PATTERN, 0, F.col("text").rlike(BARE_PATTERN)).alias(BARE))
    return rows.select("doc_id", "owner", "repository", F.monotonically_increasing_id().alias("row_id"), *columns)


def _any(*conditions: Column) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def spans(scanned: DataFrame) -> DataFrame:
    """``row_id, owner, repository, kind_no, kind, start, end, value`` of each match of enough characters; of bare tokens
    only those that overlap no base span."""
    parts = []
    for number, kind in enumerate([*KINDS, BARE]):
        each = scanned.select("row_id", "owner", "repository", F.posexplode(kind).alias("place", "m"))
        before = Window.partitionBy("row_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        each = each.withColumn("end", F.sum(F.col("m.gap") + F.length("m.match")).over(before).cast("bigint"))
        each = each.withColumn("start", F.col("end") - F.length("m.match"))
        least = KINDS[kind][2] if kind in KINDS else 0
        names = [F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"), "start", "end", F.col("m.value").alias("value")]
        parts.append(each.select("row_id", "owner", "repository", *names).where(F.length("value") >= least))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    in_row, backward = (Window.partitionBy("row_id").orderBy(o) for o in ("start", F.desc("start")))
    base = F.col("kind") != BARE
    # Frames that only grow: one with an end that follows would be made anew for each row.
    grown = Window.unboundedPreceding, Window.currentRow
    ends = F.max(F.when(base, F.col("end"))).over(in_row.rangeBetween(*grown))
    starts = F.min(F.when(base, F.col("start"))).over(backward.rangeBetween(*grown))
    found = found.withColumns({"ends": ends, "starts": starts})
    clear = F.coalesce(F.col("ends") <= F.col("start"), F.lit(True))
    clear = clear & F.coalesce(F.col("starts") >= F.col("end"), F.lit(True))
    return found.where(base | clear).drop("ends", "starts")


def ownership(found: DataFrame) -> DataFrame:
    """``value_key, owners, repositories``: of how many each value is. Hot values shrink before they are shuffled."""
    # An owner without a name is another one than one whose name is empty.
    owner, repository = (F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("owner", "repository"))
    held = found.groupBy("value_key", owner.alias("owner"), repository.alias("repository")).agg(F.count("*").alias("n"))
    by_owner = held.groupBy("value_key", "owner").agg(F.count("*").alias("repositories"))
    counted = by_owner.groupBy("value_key").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    return counted


def listed(rows: Column, condition: Callable[[Column], Column]) -> Column:
    """Spans as text: kind:start:end by start, then kind."""
    chosen = F.filter(F.sort_array(rows), condition)
    each = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def find_secrets(
    documents: DataFrame,
    owner: str = "source",
    repository: str | None = "source",
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """A row per document: numbers of base spans, their digest, all spans, and of how many the values are.

    ``owner`` and ``repository`` name columns; with None for the latter each distinct text is a repository. ``n_live`` and
    ``n_copied`` count spans whose values look live and those that are copied examples. ``counts`` has for each of the
    spans, in their order, in how many ``repositories`` of how many ``owners`` its value is.
    """
    spark = documents.sparkSession
    scanned = stored(spark, "secrets", scan(documents, owner, repository))
    some = F.size(F.concat(*[F.transform(kind, lambda m: m["gap"]) for kind in (*KINDS, BARE)])) > 0
    found = spans(scanned.where(some)).withColumn("value_key", F.sha2("value", 256))
    found = stored(spark, "secret-spans", found)
    counted = ownership(found).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("row_id", "start"), F.lit(SALTS)).cast("int"))
    known = salted.join(counted, ["value_key", "salt"])
    different = F.size(F.array_distinct(F.split("value", "")))
    random = (different >= RANDOM_CHARACTERS) & ~F.col("value").rlike(PLACEHOLDER)
    # Never fewer repositories than owners, as each owner has one at least.
    copied = (F.col("owners") >= copied_owners) | (F.col("repositories") >= max(copied_owners, copied_repositories))
    known = known.withColumns({"copied": copied, "live": random & ~copied}).where((F.col("kind") != BARE) | F.col("live"))
    each = F.struct("start", "kind_no", "end", "kind", "live", "copied", "owners", "repositories")
    by_row = known.groupBy("row_id").agg(F.collect_list(each).alias("spans"))
    empty = F.array().cast(by_row.schema["spans"].dataType)
    rows = scanned.select("doc_id", "row_id").join(by_row, "row_id", "left")
    rows = rows.withColumn("spans", F.coalesce("spans", empty))

    def count(condition: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("spans", condition)).cast("bigint")

    def of_kind(kind: str) -> Column:
        return count(lambda s: s["kind"] == kind).alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(of_kind, KINDS),
        F.sha2(listed(F.col("spans"), lambda s: s["kind"] != BARE), 256).alias("base_sha256"),
        listed(F.col("spans"), lambda s: F.lit(True)).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["copied"]).alias("n_copied"),
        F.transform(
            F.sort_array("spans"),
            lambda s: F.struct(s["owners"].alias("owners"), s["repositories"].alias("repositories")),
        ).alias("counts"),
    )
