"""Secret scans with an incremental ledger of blobs.

Every historical version of every path is content-addressed: its blob is the SHA-256 of its
UTF-8 bytes. The ledger holds a row per (blob, rule, rule version) that was ever scanned, with
the spans found, none included. A scan reads only pairs that the ledger doesn't hold yet, so
a text that many paths or versions share is scanned once, a new version of one path costs
that text alone, and a new or changed rule costs that rule alone. Findings are joined back
to every path and version. Only built-in functions run.

Defined results: a null text is the empty blob; a null path is a path like any other; repeated rows
each get their findings; other columns don't matter; no rows give no rows. Ledger rows that
were appended twice count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import stored

LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"


def either_case(word: str) -> str:
    """A pattern of ``word`` with its ASCII letters in either case, alike in every regular-expression engine."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    ``version`` names this wording: a changed rule gets another one, and old findings no longer
    count. ``needs`` is a string that every match holds, looked for first.
    """

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0
    needs: str = ""


# The kinds and patterns of the contract. Runs of one class are matched whole, so
# a least length inside the pattern drops the same matches as a check afterwards.
KEY = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
BASE = (
    Rule("assign", 1, rf"""({KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least=6, group=2),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", needs="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
# Published formats of private keys and of tokens that name their issuer.
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", needs="gh"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", needs="xox"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", needs="eyJ"),
)
RULES = BASE + MORE


def blob_of(text: Column) -> Column:
    """The content address of a text (null: empty)."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan_unseen(
    versions: DataFrame, ledger: DataFrame | None = None, *, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> DataFrame:
    """The ledger's new rows (``LEDGER``): one per blob of ``versions`` and rule version not in ``ledger``.

    ``versions`` has a row per version of a path, in any order, old ones again or not; append the
    result to the ledger (Parquet, any store) when it is whole. Copies of a text meet in their
    task first and then once per task, so no task holds the rows of a hot blob. The match of a
    rule carries how far it lies from the one before it; a window per (blob, rule) adds
    these up, as many rows as one text has matches.
    """
    blobs = versions.select(blob_of(F.col(f"`{text}`")).alias("blob"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    blobs = blobs.dropDuplicates(["blob"])
    if ledger is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(" ", "kind", "version")).alias("seen"))
        blobs = blobs.join(done, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))

    todo = [~F.array_contains("seen", f"{r.kind} {r.version}") for r in rules]
    for r, due in zip(rules, todo):
        holds = due & F.contains("text", F.lit(r.needs)) if r.needs else due
        blobs = blobs.withColumn(f"found_{r.kind}", F.when(holds, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))))
    pairs = []
    for r, due in zip(rules, todo):
        found = F.coalesce(f"found_{r.kind}", F.array().cast("array<string>"))
        between = F.transform(F.split("text", r.pattern, -1), lambda s: F.char_length(s))
        pairs.append(F.when(due, F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), found.alias("found"),
            F.when(F.size(found) > 0, F.slice(between, F.lit(1), F.size(found))).alias("gaps"),
        )))
    scanned = stored(
        blobs.select("blob", F.explode(F.array_compact(F.array(*pairs))).alias("pair")).select("blob", "pair.*"), "ledger-scan"
    )
    hits = scanned.where(F.size("found") > 0).select(
        "blob", "kind", "version", F.posexplode(F.arrays_zip("gaps", "found")).alias("n", "hit")
    ).select("blob", "kind", "version", "n", F.col("hit.found").alias("match"), F.col("hit.gaps").alias("gap"))
    ends = F.expr("sum(gap + char_length(match)) OVER (PARTITION BY blob, kind, version ORDER BY n)").cast("int")
    value = F.lit(None).cast("string")
    least = F.lit(None).cast("int")
    for r in rules:
        own = F.col("kind") == r.kind
        value = F.when(own, F.regexp_extract("match", r.pattern, r.group) if r.group else F.col("match")).otherwise(value)
        least = F.when(own, F.lit(r.least)).otherwise(least)
    spans = (
        hits.withColumn("end", ends).where(F.char_length(value) >= least)
        .select("blob", "kind", "version", F.struct((F.col("end") - F.char_length("match")).alias("start"), "end").alias("span"))
        .groupBy("blob", "kind", "version").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    )
    # every pair scanned has a row, most of them without a span
    return (
        scanned.select("blob", "kind", "version").join(spans, ["blob", "kind", "version"], "left")
        .select("blob", "kind", "version", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))
    )


def spans_by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): what the rules' present versions found, spans (start, order, end, kind) in order of start, then of
    the rules. Blobs without a finding have no row."""
    found = None
    for n, r in enumerate(rules):
        found = F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), F.lit(n)).otherwise(
            F.lit(None).cast("int") if found is None else found
        )
    return (
        ledger.where(F.size("spans") > 0).withColumn("order", found).where(F.col("order").isNotNull())
        .groupBy("blob", "kind", "order").agg(F.first("spans").alias("spans"))
        .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), F.col("order"), s["end"].alias("end"), F.col("kind"))
        )))).alias("spans"))
    )


def join_back(versions: DataFrame, ledger: DataFrame, *, keep: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Every version's columns ``keep`` and its ``spans``, as many rows as versions (an empty array: nothing found).

    Findings are first put together per blob and stored, so that the paths of a blob that a third
    of all versions share meet one row in a join that adaptive execution can split.
    """
    found = stored(spans_by_blob(ledger, rules).withColumnsRenamed({"blob": "_blob", "spans": "_spans"}), "ledger-found")
    paths = versions.select(*[F.col(f"`{c}`") for c in keep], blob_of(F.col(f"`{text}`")).alias("_path_blob"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    return paths.join(found, F.col("_path_blob") == F.col("_blob"), "left").select(
        *[F.col(f"`{c}`") for c in keep], F.coalesce("_spans", none).alias("spans")
    )


def findings(versions: DataFrame, ledger: DataFrame, *, path: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """(path, kind, start, end, secret) of every finding in every version."""
    rows = versions.select(F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text"))
    spans = join_back(rows, ledger, keep=["path", "text"], rules=rules).select("path", "text", F.explode("spans").alias("s"))
    return spans.select("path", "s.kind", "s.start", "s.end", F.substr("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("secret"))


def op11_blob_ledger(docs: DataFrame) -> DataFrame:
    """Each document is a version of the path ``doc_id``; the ledger begins empty."""
    versions = docs.select("doc_id", "text")
    ledger = stored(scan_unseen(versions), "ledger")
    rows = join_back(versions, ledger, keep=["doc_id"])

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["order"] < len(BASE))

    def count(n: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["order"] == n)).cast("long").alias(f"n_{BASE[n].kind}")

    counts = [count(n) for n in range(len(BASE))]
    return rows.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The query's rows as DuckDB SQL, each rule over every document."""
    quoted = [r.pattern.replace("'", "''") for r in rules]
    found = "\n  UNION ALL ".join(
        f"SELECT r, '{r.kind}' AS kind, {n} AS ord, {r.least} AS least, unnest(m) AS m, "
        f"unnest(regexp_extract_all(t, '{p}', {r.group})) AS v, unnest(list_slice(string_split_regex(t, '{p}'), 1, len(m))) AS gap, "
        f"generate_subscripts(m, 1) AS i FROM (SELECT r, t, regexp_extract_all(t, '{p}') AS m FROM d)"
        for n, (r, p) in enumerate(zip(rules, quoted))
    )
    base = len(BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE ord = {n}) AS n_{r.kind}" for n, r in enumerate(BASE))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS (
  {found}
), placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, ord ORDER BY i) AS stop FROM found
), spans AS (
  SELECT r, ord, stop - length(m) AS start, kind || ':' || (stop - length(m)) || ':' || stop AS span
  FROM placed WHERE length(v) >= least
), per AS (
  SELECT r, {counts}, string_agg(span, ',' ORDER BY start, ord) FILTER (WHERE ord < {base}) AS base,
         string_agg(span, ',' ORDER BY start, ord) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)
"""


SQL = sql()
