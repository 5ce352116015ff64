"""Secret scans: candidates by pattern, told apart by who owns them across the corpus.

Every candidate value is counted by the distinct repositories and owners it occurs in.  A value that
many owners or many repositories hold is a copied example; one that few hold and that is varied enough to be
a real key looks live.  Built-in functions only: matches and the gaps between them give the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import stored

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "live")
MIN_ASSIGNED = 8
#: Some surviving match of the kind exists if and only if this is found.
_QUICK_ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}"
)

#: Values of so many owners, or of so many repositories of fewer owners, are examples; live ones have at least
#: so many different characters.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 6
LIVE_CHARACTERS = 8
MASK = "[SECRET]"

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _no_spans() -> Column:
    return F.array().cast(_SPAN)


def _found(text: Column, pattern: str, kind: int, group: int) -> Column:
    """Spans of all leftmost, non-overlapping matches, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # the gap before each match
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: F.struct(
        m.alias("match"), g.alias("gap")
    ))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), _no_spans().alias("spans"))

    def walk(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["match"])
        value = F.regexp_extract(x["match"], pattern, group) if group else x["match"]
        span = F.struct(
            begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value")
        )
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(both, start, walk, lambda acc: acc["spans"])


def base_spans(text: Column) -> Column:
    """Base spans of a whole text by start, then kind; a null text has none.

    ``value`` is what is secret: the assigned text, otherwise the whole match.
    """
    text = F.coalesce(text, F.lit(""))
    assigned = F.when(
        text.rlike(_QUICK_ASSIGN),
        F.filter(_found(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_ASSIGNED),
    ).otherwise(_no_spans())
    access = F.when(text.rlike(ACCESS), _found(text, ACCESS, 1, 0)).otherwise(_no_spans())
    digits = F.when(text.rlike(HEX), _found(text, HEX, 2, 0)).otherwise(_no_spans())
    return F.sort_array(F.concat(assigned, access, digits))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """Per value digest: ``n_repositories``, ``n_owners``, ``n_found``, ``verdict``.

    ``candidates`` has ``digest``, ``varied``, ``repository``, ``owner``, any number of times.  A
    null owner counts as one owner, a null repository as one repository.
    """
    def named(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    counted = candidates.groupBy("digest", "varied").agg(
        F.count_distinct(named("repository")).alias("n_repositories"),
        F.count_distinct(named("owner")).alias("n_owners"),
        F.count(F.lit(1)).alias("n_found"),
    )
    copied = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
    verdict = F.when(copied, "example").when(
        F.col("varied"), "live"
    ).otherwise("plain")
    return counted.withColumn("verdict", verdict)


def _candidates(scanned: DataFrame) -> DataFrame:
    exploded = scanned.filter(F.size("base") > 0).select(
        "row", "owner", "repository", F.explode("base").alias("s")
    )
    characters = F.size(F.array_distinct(F.split(F.col("s.value"), "")))
    return exploded.withColumn("digest", F.sha2("s.value", 256)).withColumn(
        "varied", characters >= LIVE_CHARACTERS
    )


def _live_spans(scanned: DataFrame) -> DataFrame:
    """Per row number the spans of live-looking values; a row without any is left out."""
    candidates = _candidates(scanned)
    live = stored(
        ownership(candidates).filter("verdict = 'live'").select(F.col("digest").alias("_live")),
        "live-values",
    )
    span = F.struct(
        (F.col("s.end") - F.length("s.value")).alias("start"), F.lit(3).alias("kind"),
        F.col("s.end").alias("end"), F.col("s.value").alias("value"),
    )
    return candidates.join(live, F.col("digest") == F.col("_live")).groupBy(
        F.col("row").alias("_row")
    ).agg(F.sort_array(F.collect_set(span)).cast(_SPAN).alias("live"))


def scan(
    docs: DataFrame, owner: Column, repository: Column, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``base`` and ``live`` spans per row; null and empty texts have none.

    Texts are read once; what goes on is a row of spans per document.  Only spans of one document
    are ever gathered.  Rows of one ID and null IDs are rows of their own.
    """
    scanned = stored(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"), owner.alias("owner"),
            repository.alias("repository"), base_spans(F.col(text_column)).alias("base"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "scanned",
    )
    return scanned.join(_live_spans(scanned), F.col("row") == F.col("_row"), "left").select(
        "doc_id", "base", F.coalesce("live", _no_spans()).alias("live")
    )


def _masked(text: Column, spans: Column) -> Column:
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def walk(acc: Column, s: Column) -> Column:
        begin = F.greatest(acc["at"], s["start"])
        between = F.substring(text, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        covered = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(covered, acc["out"]).otherwise(F.concat(acc["out"], between, F.lit(MASK))).alias("out"),
        )

    return F.aggregate(spans, start, walk, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
    ))


def mask_live(
    docs: DataFrame, owner: Column, repository: Column, text_column: str = "text",
) -> DataFrame:
    """The same documents with live-looking values replaced by ``MASK``; other columns stay.

    Documents without any candidate are passed on as they are read; only those with one are joined.
    """
    columns = docs.columns
    spotted = docs.withColumn("_base", base_spans(F.col(text_column)))
    numbered = stored(
        spotted.filter(F.size("_base") > 0).withColumn("_n", F.monotonically_increasing_id()),
        "candidates",
    )
    scanned = numbered.select(
        F.col("_n").alias("row"), owner.alias("owner"), repository.alias("repository"),
        F.col("_base").alias("base"),
    )
    joined = numbered.join(_live_spans(scanned), F.col("_n") == F.col("_row"), "left")
    masked = joined.withColumn(
        text_column,
        F.when(F.col("live").isNull(), F.col(text_column)).otherwise(
            _masked(F.col(text_column), F.col("live"))
        ),
    ).select(*columns)
    return spotted.filter(F.size("_base") == 0).select(*columns).unionByName(masked)
