"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Base spans come from three fixed patterns.  Beyond them, long opaque values
are candidates; every candidate's value hash is aggregated over the corpus by
distinct repositories and owners.  A value that several owners hold is a
copied example, as is one of two owners in many repositories; one that a single owner holds is
live if it looks random, by the number of its different characters, else weak.  Live opaque candidates are added to the spans, base spans always stay,
and each document tells how many of its spans are live or examples.

Spans are found inside each row (split gives the gaps between matches, their
lengths the positions), written once to the shared folder without the texts,
and only spans, never texts, are shuffled.  Distinct owners are counted by
aggregations that combine before the shuffle, so an example that a third of
all documents holds costs one row a task and owner.

Defined results: null or empty text has no spans; a null repository or owner
counts as one value of its own; repeated rows (also of one doc_id) keep one
result each; an empty table gives an empty result; other columns pass by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantlake.session import materialize

#: Fixed patterns of the base spans: kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
               r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Opaque values: 24 or more characters of one token; digits and both cases must occur.
OPAQUE = ("opaque", r"[A-Za-z0-9+/_=-]{24,}", 0, 24)
#: Different characters from which a value looks random (a random hex value of 16 has ten on average).
LEAST_DISTINCT = 8
KINDS = ("assign", "access", "hex", "opaque")
#: A cheap test that every text with an assignment passes.
_HINTS = ("passw", "secret", "token", "apikey", "api_key")


def _running(rows: Column, merge) -> Column:
    """array<struct> in which every row holds merge(row before by d, row) for d = 1, 2, 4, ...: a running total in n log n steps, without copying lists."""
    def double(acc, d):
        def with_earlier(x, i):
            earlier = F.get(acc, i - d)
            return F.when(i >= d, merge(earlier, x)).otherwise(x)
        return F.when(F.size(acc) > d, F.transform(acc, with_earlier)).otherwise(acc)

    return F.aggregate(F.array(*[F.lit(1 << j) for j in range(31)]), rows, double)


def _let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, hint: Column | None = None) -> Column:
    """array<struct<start, rank, end, kind, value>> of the leftmost non-overlapping matches whose group is long enough."""
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    whole = F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda m: F.length(m))
    value = F.regexp_extract_all(text, p, F.lit(group))
    parts = F.filter(F.arrays_zip(gaps.alias("gap"), whole.alias("size"), value.alias("value")), lambda x: x["size"].isNotNull())

    def row(end, x):
        return F.struct(end.alias("end"), x["size"].alias("size"), x["value"].alias("value"))

    ends = _running(F.transform(parts, lambda x: row(x["gap"] + x["size"], x)), lambda before, x: row(before["end"] + x["end"], x))
    found = F.transform(F.filter(ends, lambda x: F.length(x["value"]) >= least),
                        lambda x: F.struct((x["end"] - x["size"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"),
                                           F.lit(kind).alias("kind"), x["value"].alias("value")))
    empty = F.expr("CAST(array() AS array<struct<start:int,rank:int,end:int,kind:string,value:string>>)")
    test = text.rlike(pattern) if hint is None else hint & text.rlike(pattern)
    return F.when(F.coalesce(test, F.lit(False)), found).otherwise(empty)


def _hinted(text: Column) -> Column:
    low = F.lower(text)
    out = low.contains(_HINTS[0])
    for h in _HINTS[1:]:
        out = out | low.contains(h)
    return out


def candidates(docs: DataFrame, text: Column, repository: Column, owner: Column) -> DataFrame:
    """One row a document: doc_id, row, repository, owner, spans (base and opaque, sorted)."""
    opaque = F.filter(_spans(text, *OPAQUE), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"))
    arrays = [_spans(text, *b, hint=_hinted(text) if b[0] == "assign" else None) for b in BASE]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.xxhash64(text).alias("text_hash"),
                       repository.alias("repository"), owner.alias("owner"),
                       F.array_sort(F.concat(*arrays, opaque)).alias("spans"))


def verdicts(rows: DataFrame, example_owners: int = 3, example_repositories: int = 5) -> DataFrame:
    """value_hash, n_repositories, n_owners, n_spans, verdict of every candidate value of the corpus.

    verdict: example (example_owners or more owners, or two with example_repositories or more
    repositories), shared (two or more owners), live (one owner, LEAST_DISTINCT or more different
    characters), weak (one owner, fewer).
    Values are grouped by SHA-256.  Two aggregations count distinct pairs, so
    a value's rows meet once for each distinct owner and repository only.
    """
    each = (rows.select("repository", "owner", F.explode("spans").alias("s"))
            .select(F.sha2(F.col("s.value"), 256).alias("value_hash"), "repository", "owner", _looks_random(F.col("s.value")).alias("random")))
    pairs = each.groupBy("value_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"), F.first("random").alias("random"))
    owners = (pairs.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"), F.first("random").alias("random"))
              .groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"),
                                         F.sum("n").alias("n_spans"), F.first("random").alias("random")))
    copied = (F.col("n_owners") >= example_owners) | ((F.col("n_owners") >= 2) & (F.col("n_repositories") >= example_repositories))
    return owners.withColumn("verdict", F.when(copied, "example").when(F.col("n_owners") >= 2, "shared")
                             .when(F.col("random"), "live").otherwise("weak")).drop("random")


def _looks_random(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None,
         example_owners: int = 3) -> DataFrame:
    """doc_id, row, base_spans, spans, n_live, n_examples: structs of (start, rank, end, kind, value, verdict)."""
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    rows = materialize(candidates(docs, F.col("text").cast("string"), repository, owner), "secret-spans")
    verdict = verdicts(rows, example_owners).select("value_hash", "verdict")
    each = (rows.select("row", F.explode("spans").alias("s"))
            .withColumn("value_hash", F.sha2(F.col("s.value"), 256)).join(verdict, "value_hash", "left"))
    stays = (F.col("s.kind") != "opaque") | (F.col("verdict") == "live")
    per = (each.where(stays).groupBy("row")
           .agg(F.array_sort(F.collect_list(F.struct("s.start", "s.rank", "s.end", "s.kind", "s.value", "verdict"))).alias("spans")))
    empty = F.expr("CAST(array() AS array<struct<start:int,rank:int,end:int,kind:string,value:string,verdict:string>>)")
    out = rows.select("doc_id", "row", "text_hash").join(per, "row", "left").withColumn("spans", F.coalesce("spans", empty))
    return (out.withColumn("base_spans", F.filter("spans", lambda s: s["kind"] != "opaque"))
            .withColumn("n_live", F.size(F.filter("spans", lambda s: s["verdict"] == "live")).cast("long"))
            .withColumn("n_examples", F.size(F.filter("spans", lambda s: s["verdict"] == "example")).cast("long")))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples of scan()'s rows."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(b[0]) for b in BASE], F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), "n_live", "n_examples")


def _mask(text: Column, spans: Column, mask: str) -> Column:
    """text with the union of the spans replaced; spans are sorted by start.

    Spans are worked off in groups of about the root of their number, each within the part of the
    text from where the group before ended, so that no position is sought from the start of the text for every span.
    """
    def row(reach, s):
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), reach.alias("reach"))

    reached = _running(F.transform(spans, lambda s: row(s["end"], s)), lambda before, s: row(F.greatest(before["reach"], s["reach"]), s))

    def masked(all_spans):
        size = F.ceil(F.sqrt(F.size(all_spans))).cast("int")

        def reach_before(i):
            return F.coalesce(F.get(all_spans, i - 1)["reach"], F.lit(0))

        def group(first):
            begin = reach_before(first)
            last = F.get(all_spans, F.least(first + size, F.size(all_spans)) - 1)["reach"]

            def pieces(part):
                def piece(s, i):
                    at = reach_before(first + i)
                    kept = F.concat(F.substring(part, at - begin + 1, s["start"] - at), F.lit(mask))
                    return F.when(s["start"] >= at, kept).otherwise("")
                return F.array_join(F.transform(F.slice(all_spans, first + 1, size), piece), "")
            return _let(F.substring(text, begin + 1, last - begin), pieces)

        firsts = F.sequence(F.lit(0), F.size(all_spans) - 1, size)
        rest = reach_before(F.size(all_spans))
        return F.concat(F.array_join(F.transform(firsts, group), ""), F.substring(text, rest + 1, F.length(text)))

    return F.when(F.size(spans) > 0, _let(reached, masked)).otherwise(text)


def redact(docs: DataFrame, mask: str = "[SECRET]", example_owners: int = 3) -> DataFrame:
    """The documents with every secret that isn't a copied example (live, weak or shared) replaced by ``mask``; all rows stay.

    Only the spans of rows that have some are joined back, by doc_id and text
    hash, so repeated rows get the same result.  n_chars is set anew for
    changed texts.
    """
    hit = (scan(docs, example_owners=example_owners)
           .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"),
                   F.filter("spans", lambda s: s["verdict"] != "example").alias("spans"))
           .where(F.size("spans") > 0).dropDuplicates(["id", "hash"]))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    own = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))
    out = rows.join(hit, own, "left").withColumn("masked", F.when(F.col("spans").isNotNull(), _mask(F.col("text"), F.col("spans"), mask)))
    new = {"text": F.coalesce("masked", "text"),
           "n_chars": F.when(F.col("masked").isNotNull(), F.length("masked").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
