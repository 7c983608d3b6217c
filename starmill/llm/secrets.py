"""Secret scan with linking of the parts of a credential. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.rows import identified

#: Kinds in the order of the report: the base ones, then those that count only when linked.
KINDS = ["assign", "access", "hex", "id", "key", "endpoint"]
#: Kind, expression, group whose length is tested (0: the match), shortest length.
PATTERNS = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
    "id": (r"""(?i:(?:client_id|access_key_id|account_id|username|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}+)""", 0, 1),
    "key": (
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
        r"[A-Za-z0-9+/_-]{16,}+", 0, 16),
    # A host is the whole run of its characters, found once and never taken apart again, so a run of any
    # length is read in linear time and without recursion; _well_formed looks at its labels.
    "endpoint": (
        r"""https?://[^\s"'<>]++|(?<![a-z0-9.-])(?=[a-z0-9-]++\.)[a-z0-9.-]++:[0-9]{2,5}+\b""", 0, 4),
}
#: What each part needs near it, by role, to be reported.
IDENTIFIERS, SECRETS = ["access", "id"], ["assign", "hex", "key"]


def _any_of(text: Column, marks: list[str]) -> Column:
    found = text.contains(marks[0])
    for mark in marks[1:]:
        found = found | text.contains(mark)
    return found


def _screens() -> dict[str, Column]:
    """Cheap tests that every text with a match of the kind passes."""
    low = F.lower("text")
    named = F.col("text").contains("AKIA") | _any_of(
        low, ["client_id", "access_key_id", "account_id", "username", "login"]
    )
    return {
        "assign": _any_of(low, ["password", "passwd", "secret", "token", "apikey", "api_key"]),
        "access": F.col("text").contains("AKIA"),
        "hex": F.col("text").rlike("[0-9a-f]{32}"),
        "id": named, "key": named, "endpoint": named,  # each of these needs an identifier nearby
    }


def _well_formed(endpoint: Column) -> Column:
    """Every label of a host has a character; an address with a scheme is taken as it is."""
    return endpoint.startswith("http") | ~(endpoint.contains("..") | endpoint.contains(".:"))


def _matches(kind: str, screen: Column) -> Column:
    """``kind``, ``k``, ``gap`` (code points before it since the last match), ``size``, ``tested``."""
    pattern, group, _ = PATTERNS[kind]
    gaps = F.split("text", pattern, -1)
    hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    tested = hits if not group else F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    if kind == "endpoint":
        tested = F.transform(hits, lambda h: F.when(_well_formed(h), h).otherwise(""))
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), tested.alias("part"))
    rows = F.transform(
        zipped,
        lambda x, k: F.struct(
            F.lit(kind).alias("kind"), k.alias("k"), F.length(x["gap"]).alias("gap"),
            F.length(x["hit"]).alias("size"), F.length(x["part"]).alias("tested"),
        ),
    )
    return F.when(screen, rows)


def candidates(docs: DataFrame) -> DataFrame:
    """``rid``, ``kind``, ``start``, ``end`` of every base span and weak candidate, in code points."""
    text = docs.select("rid", F.coalesce(F.col("body").cast("string"), F.lit("")).alias("text"))
    found = [_matches(kind, screen) for kind, screen in _screens().items()]
    rows = text.select("rid", F.array_compact(F.array(*found)).alias("found")).filter(F.size("found") > 0)
    each = rows.select("rid", F.explode(F.flatten("found")).alias("m")).select("rid", "m.*").filter("size IS NOT NULL")
    before = Window.partitionBy("rid", "kind").orderBy("k")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
    long_enough = F.lit(False)
    for kind, (_, _, least) in PATTERNS.items():
        long_enough = long_enough | ((F.col("kind") == kind) & (F.col("tested") >= least))
    return placed.filter(long_enough).select("rid", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(found: DataFrame, scope: int = 200) -> DataFrame:
    """The base spans, and the weak candidates whose complementary parts lie in their scope.

    The scope of a span reaches ``scope`` code points to either side. Spans are joined with the
    scopes by one sweep per document in order of the start: the furthest end of a role so far and
    its next start say whether one lies in reach, so no pair is ever made. A weak key needs an
    identifier, a weak identifier a secret, an endpoint both; a candidate that overlaps a base
    span is part of that span.
    """
    order = Window.partitionBy("rid").orderBy("start")
    back = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Backwards, so that this too is a running value; a frame that ends with the document is made anew for every row.
    ahead = Window.partitionBy("rid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    base, kind = KINDS[:3], F.col("kind")

    def near(role: Column, reach: int) -> Column:
        end, start = F.max(F.when(role, F.col("end"))).over(back), F.min(F.when(role, F.col("start"))).over(ahead)
        return F.coalesce(end > F.col("start") - reach, F.lit(False)) | F.coalesce(start < F.col("end") + reach, F.lit(False))

    marked = found.select(
        "*", near(kind.isin(*IDENTIFIERS), scope).alias("named"), near(kind.isin(*SECRETS), scope).alias("secret"),
        near(kind.isin(*base), 0).alias("covered"),
    )
    weak = (
        ((kind == "key") & F.col("named")) | ((kind == "id") & F.col("secret"))
        | ((kind == "endpoint") & F.col("named") & F.col("secret"))
    )
    return marked.filter(kind.isin(*base) | (weak & ~F.col("covered"))).select("rid", "kind", "start", "end")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """One row per document: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``.

    Null and empty texts have no span. Rows that share an id are documents of their own. Only
    spans are shuffled; texts stay where they are read. Every pattern reads a text in time linear in its length, also
    megabytes of dots, hyphens or colons; a very long text needs memory for its matches.
    """
    base = identified(docs, id_col, text_col)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = linked(candidates(base), scope).select("rid", F.struct("start", place.alias("place"), "end", "kind").alias("s"))
    per_doc = spans.groupBy("rid").agg(F.array_sort(F.collect_list("s")).alias("s"))
    all_docs = base.select("rid", "doc_id").join(per_doc, "rid", "left")
    s = F.coalesce("s", F.array().cast(per_doc.schema["s"].dataType))
    base_spans = F.filter(s, lambda x: x["place"] <= 3)

    def many(k: int) -> Column:
        return F.size(F.filter(s, lambda x: x["place"] == k)).cast("long")

    return all_docs.select(
        "doc_id", many(1).alias("n_assign"), many(2).alias("n_access"), many(3).alias("n_hex"),
        F.sha2(_joined(base_spans), 256).alias("base_sha256"), _joined(s).alias("spans"),
    )
