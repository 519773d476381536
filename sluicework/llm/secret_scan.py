"""Secret scans, with the frequency of ownership over the whole corpus as the judge.

DataFrame functions only.  Three base kinds are found by pattern.  A fourth, ``owned``, starts as
any opaque run of letters and digits: the runs' hashes are counted by distinct owners and
repositories over the whole corpus, and a run that few owners share is a live-looking credential
of its owner, while one that many share is a copied example (a checksum, a documented key).  The
same count marks every base span as live or as an example.

Places come from cutting a text at its matches: pieces and matches alternate, so their lengths add
up to the starts.  Only texts that hold a candidate are cut and only candidates are shuffled; they
are counted per hash, owner and repository first, and meet the counts in a salted join, so a secret
in a third of all rows is spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.columns import let, positions, same_row, text_key
from sluicework.sources.storage import Staging

# The base kinds in their order, their patterns, and the least length of a match.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "owned")

# Candidates of the fourth kind: a run of this length with at least so many digits and letters.
OPAQUE = r"[A-Za-z0-9_-]{20,}"
OPAQUE_DIGITS = 4
OPAQUE_LETTERS = 4
# What more owners or more repositories share is a copied example.
MOST_OWNERS = 2
MOST_REPOSITORIES = 20
SALTS = 16


def _matches(text: Column, kind: str, pattern: str, value_group: int) -> Column:
    """Array of (start, end, kind, value) of a pattern's leftmost non-overlapping matches."""
    rank = KINDS.index(kind) + 1
    none = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")

    def cut(matched: Column) -> Column:
        def starts(pieces: Column) -> Column:
            def step(seen: Column, i: Column) -> Column:
                start = seen["at"] + F.length(F.get(pieces, i))
                return F.struct(
                    (start + F.length(F.get(matched, i))).alias("at"),
                    F.array_append(seen["starts"], start).alias("starts"),
                )

            before = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
            return F.aggregate(
                positions(F.size(matched)), before, step, lambda seen: seen["starts"]
            )

        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
        return let(
            F.struct(
                let(F.split(text, pattern, -1), starts).alias("starts"), values.alias("values")
            ),
            lambda both: F.transform(
                both["starts"],
                lambda start, i: F.struct(
                    start.alias("start"),
                    F.lit(rank).alias("rank"),
                    (start + F.length(F.get(matched, i))).alias("end"),
                    F.get(both["values"], i).alias("value"),
                ),
            ),
        )

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), cut)
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """The base kinds' spans: ``start``, ``rank`` of the kind, ``end``, and the secret ``value``."""
    assign = F.filter(
        _matches(text, "assign", ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_VALUE
    )
    return F.array_sort(
        F.concat(assign, _matches(text, "access", ACCESS, 0), _matches(text, "hex", HEX, 0))
    )


def opaque_spans(text: Column) -> Column:
    """Candidates of the fourth kind."""
    return F.filter(
        _matches(text, "owned", OPAQUE, 0),
        lambda s: (F.regexp_count(s["value"], F.lit("[0-9]")) >= OPAQUE_DIGITS)
        & (F.regexp_count(s["value"], F.lit("[A-Za-z]")) >= OPAQUE_LETTERS),
    )


def _may_hold(text: Column) -> Column:
    """Whether a text has a match of any pattern; null for null."""
    return F.rlike(text, F.lit(f"{ASSIGN}|{ACCESS}|{HEX}|{OPAQUE}"))


def candidates(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """A row per candidate span of each document that has one.

    An opaque run that overlaps a base span is that span's, not a candidate of its own.
    """
    known = docs.select(
        "doc_id",
        text_key(),
        "text",
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
    ).filter(_may_hold(F.col("text")))
    both = known.select(
        "doc_id",
        "text_key",
        "owner",
        "repository",
        base_spans(F.col("text")).alias("base"),
        opaque_spans(F.col("text")).alias("opaque"),
    )
    apart = F.filter(
        "opaque",
        lambda o: ~F.exists(
            "base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])
        ),
    )
    return both.select(
        "doc_id", "text_key", "owner", "repository", F.inline(F.concat("base", apart))
    ).select(
        "doc_id",
        "text_key",
        "owner",
        "repository",
        "start",
        "rank",
        "end",
        F.md5(F.col("value").cast("binary")).alias("secret"),
    )


def ownership(found: DataFrame, unit: str = "repository") -> DataFrame:
    """``secret, n_owners, n_repositories`` of every candidate hash of the corpus.

    Repositories are told apart by ``unit``: by ``text_key``, copies of a text count as one.
    """
    return (
        found.groupBy("secret", "owner", unit)
        .agg(F.count("*").alias("n"))
        .groupBy("secret", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("secret")
        .agg(
            F.count("*").alias("n_owners"),
            F.sum("repositories").alias("n_repositories"),
        )
    )


def judged_spans(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
    by_owner: bool = False,
) -> DataFrame:
    """Per document with spans: ``doc_id, text_key, spans`` of (start, rank, end, live), in order.

    Base spans all stay; an opaque run stays only if it is live.  ``by_owner``: what one owner alone
    has is live however many of its documents have it, and else repositories are distinct texts.
    """
    # Texts are matched once; the candidates, few rows, are read for the counts and for the spans.
    found = Staging(docs.sparkSession).table(candidates(docs, owner, repository))
    few = F.col("n_repositories") <= most_repositories
    if by_owner:
        few = few | (F.col("n_owners") == 1)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)))
    counts = ownership(found, "text_key" if by_owner else "repository").select(
        "secret",
        ((F.col("n_owners") <= most_owners) & few).alias("live"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"),
    )
    owned = KINDS.index("owned") + 1
    return (
        salted.join(counts.hint("merge"), ["secret", "salt"])
        .filter(F.col("live") | (F.col("rank") < owned))
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", "rank", "end", "live"))).alias("spans"))
    )


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["rank"] - 1), s["start"], s["end"])
        ),
        ",",
    )


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Per row of ``docs`` its spans: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` and
    ``n_owned``, ``n_live`` (spans that few owners share).

    Places are code points, ends exclusive; spans are listed as kind:start:end by start, then in the
    order of ``KINDS``.  A null or empty text has none.  A null owner or repository counts as one
    owner or repository.  Rows that repeat are answered each, rows with one ``doc_id`` are told
    apart by their text.  Other columns are ignored.
    """
    found = judged_spans(docs, owner, repository)
    base = docs.select("doc_id", text_key())
    joined = base.join(found, same_row(base, found), "left").select(
        base["doc_id"],
        F.coalesce(
            "spans", F.array().cast("array<struct<start:int,rank:int,end:int,live:boolean>>")
        ).alias("found"),
    )

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    base_only = F.filter("found", lambda s: s["rank"] < KINDS.index("owned") + 1)
    return joined.select(
        "doc_id",
        *[count(KINDS.index(kind) + 1).alias(f"n_{kind}") for kind in KINDS],
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.sha2(_listed(base_only).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs`` with every span replaced: ``[SECRET]`` where it looks live, else ``[EXAMPLE]``.

    Owners are judged first, so a credential of one owner goes from all of its documents.  An opaque
    run that is not live is no span and stays.  Overlapping spans are replaced once, by the mark of
    the first.  All columns stay; ``n_chars``, where there is one, becomes the length of the new text.
    """
    found = judged_spans(docs, owner, repository, by_owner=True).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__s")
    )
    same = docs["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(docs["text"]) == found["__key"])

    def after(seen: Column, span: Column) -> Column:
        mark = F.when(span["live"], F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE]"))
        before = F.substring(F.col("text"), seen["at"] + 1, span["start"] - seen["at"])
        inside = span["start"] < seen["at"]
        return F.struct(
            F.greatest(seen["at"], span["end"]).alias("at"),
            F.when(inside, seen["out"])
            .otherwise(F.concat(seen["out"], before, mark))
            .alias("out"),
        )

    cleaned = F.aggregate(
        F.col("__s"),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        after,
        lambda seen: F.concat(
            seen["out"], F.substring(F.col("text"), seen["at"] + 1, F.length(F.col("text")))
        ),
    )
    # Only texts with a candidate are joined; the others, nearly all, stay where they are.
    may = F.coalesce(_may_hold(F.col("text")), F.lit(False))
    joined = docs.filter(may).join(found.hint("merge"), same, "left")
    new = joined.withColumn(
        "text", F.when(F.col("__s").isNull(), F.col("text")).otherwise(cleaned)
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.length(F.col("text")).cast(kind)
        new = new.withColumn(
            "n_chars", F.when(F.col("__s").isNull(), F.col("n_chars")).otherwise(changed)
        )
    return new.select(*docs.columns).union(docs.filter(~may))
