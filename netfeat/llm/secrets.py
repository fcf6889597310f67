"""Secret scan with corpus-wide ownership frequency, in DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace, row_key, unused

#: fixed values: kinds in their order, patterns, and the least length of the part that counts
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
# end of fixed values

#: What the method looks at besides: long runs that mix cases and digits.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_DIFFERENT = 10
#: A value that so many owners or more hold is a widely copied example.
COPIED_OWNERS = 3
#: One owner may hold a live credential in a few repositories; a value in so many is copied from an example.
COPIED_REPOSITORIES = 10
REDACTED = "[SECRET]"
_BLOCK = 1000


def running(lengths: Column) -> Column:
    """The sum of the entries before each entry, in two levels so that long arrays stay cheap."""

    def sums(a: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(
            a, start,
            lambda s, x: F.struct((s["total"] + x).alias("total"), F.concat(s["before"], F.array(s["total"])).alias("before")),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(lengths) - 1, F.lit(0)) / _BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * _BLOCK + 1, _BLOCK),
    )
    parts = F.transform(blocks, sums)
    offsets = sums(F.transform(parts, lambda p: p["total"]))["before"]
    return F.flatten(F.zip_with(parts, offsets, lambda p, o: F.transform(p["before"], lambda x: x + o)))


def _matches(df: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds ``name``: array of (start, end, value) of the leftmost non-overlapping matches, in code
    points. A split gives the texts between the matches; the running lengths give the places."""
    text = F.col("text")
    df = df.withColumn("_found", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    value = F.col("_found") if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    some = F.size("_found") > 0
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    df = df.withColumns({"_value": F.when(some, value), "_between": F.when(some, F.split(text, pattern, -1))})
    count = F.size("_found")
    df = df.withColumn(
        "_gap", F.transform(F.slice("_between", 1, F.greatest(count, F.lit(1))), lambda x: F.length(x).cast("long"))
    ).withColumn("_size", F.transform("_found", lambda x: F.length(x).cast("long")))
    df = df.withColumn("_at", F.when(some, running(F.zip_with("_gap", "_size", lambda a, b: a + b))))
    spans = F.zip_with(
        F.zip_with("_at", "_gap", lambda a, b: a + b),
        F.arrays_zip("_size", "_value"),
        lambda s, m: F.struct(s.alias("start"), (s + m["_size"]).alias("end"), m["_value"].alias("value")),
    )
    return df.withColumn(name, F.when(some, spans).otherwise(empty)).drop("_found", "_value", "_between", "_gap", "_size", "_at")


def _spans(name: str, kind: str) -> Column:
    k = KINDS.index(kind)
    kept = F.filter(name, lambda m: F.length(m["value"]) >= LEAST.get(kind, 0))
    return F.transform(
        kept,
        lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), m["value"].alias("value")),
    )


def _live_looking(value: Column) -> Column:
    return (
        value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DIFFERENT)
    )


def scanned(docs: DataFrame) -> DataFrame:
    """Adds ``base`` and ``more``: arrays of (start, kind, end, value), the base spans by start and kind and the
    live-looking runs that overlap none of them."""
    df = _matches(docs, "_assign", ASSIGN, 2)
    df = _matches(df, "_access", ACCESS)
    df = _matches(df, "_hex", r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones hide no match
    df = _matches(df, "_run", CANDIDATE)
    base = F.array_sort(F.concat(_spans("_assign", "assign"), _spans("_access", "access"), _spans("_hex", "hex")))
    df = df.withColumn("base", base)
    apart = F.filter(
        _spans("_run", "owned"),
        lambda m: _live_looking(m["value"])
        & ~F.exists("base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])),
    )
    return df.withColumn("more", apart).drop("_assign", "_access", "_hex", "_run")


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owner, repository) -> (hash, n_owners, n_repositories): distinct counts.

    Each level combines before its shuffle, so a value that a third of all rows hold is a row a task."""
    by_repository = candidates.select("hash", "owner", "repository").distinct()
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str = "doc_id",
) -> DataFrame:
    """One row a document: (doc_id, row, base, spans, n_copied), spans as arrays of (start, kind, end, value).

    The base spans are the matches of the three patterns. Every value found, also that of a
    live-looking run outside them, is counted over the corpus by the distinct owners and
    repositories that hold it. A run of fewer than ``COPIED_OWNERS`` owners and fewer than ``COPIED_REPOSITORIES``
    repositories is a credential of
    its owner and becomes a span of the kind ``owned``; one of more is a copied example and does not.
    ``n_copied`` counts the base spans whose value is such an example; base spans stay all the same.

    A null text is empty, a null owner or repository counts as one of its own, documents
    without spans have empty arrays, rows that repeat an id are rows of their own, an empty table
    gives an empty result, other columns are ignored. Texts are read once and never shuffled."""
    work = Workspace(docs.sparkSession, "secrets")
    docs = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(id_col, text_col).alias("row"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(repository_col).cast("string").alias("repository"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    found = scanned(docs).drop("text").withColumn("at", F.monotonically_increasing_id())
    found = work.store(found, "found")  # from here on ``at`` is fixed
    every = found.select("at", "owner", "repository", F.explode(F.concat("base", "more")).alias("span"))
    every = every.select("*", F.sha2("span.value", 256).alias("hash"))
    copied = (F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_repositories") >= COPIED_REPOSITORIES)
    judged = every.join(ownership(every), "hash").groupBy("at").agg(
        F.collect_list(F.when((F.col("span.kind") == KINDS.index("owned")) & ~copied, F.col("span"))).alias("owned"),
        F.count(F.when((F.col("span.kind") != KINDS.index("owned")) & copied, 1)).alias("n_copied"),
    )
    out = found.join(judged, "at", "left")
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return out.select(
        "doc_id", "row", "base",
        F.array_sort(F.concat("base", F.coalesce("owned", empty))).alias("spans"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
    )


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def digests(spans: DataFrame) -> DataFrame:
    """Counts, digest and lists of ``secret_spans``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        "n_copied",
    )


def redacted(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by ``REDACTED``; overlapping spans become one."""
    key, found, result = unused(docs, "_row", "_spans", "_done")
    hits = spans.where(F.size("spans") > 0).select(F.col("row").alias(key), F.col("spans").alias(found))
    hits = hits.dropDuplicates([key])
    keyed = docs.withColumn(key, row_key(id_col, text_col)).join(hits, key, "left")
    text = F.col(text_col)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(s: Column, m: Column) -> Column:
        fresh = m["start"] >= s["at"]
        between = F.substring(text, (s["at"] + 1).cast("int"), (m["start"] - s["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(s["out"], between, F.lit(REDACTED))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], m["end"]).alias("at"),
        )

    done = F.aggregate(found, start, step)
    keyed = keyed.withColumn(result, F.when(F.col(found).isNotNull(), done))
    rest = F.substring(text, (F.col(result)["at"] + 1).cast("int"), F.length(text))
    new = F.when(F.col(result).isNotNull(), F.concat(F.col(result)["out"], rest)).otherwise(text)
    return keyed.withColumn(text_col, new).select(*docs.columns)
