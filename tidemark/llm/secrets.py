"""Secret scans over an incremental blob ledger (operator 7).

Texts are content-addressed: a blob is the SHA-256 of a text, and the ledger
knows which pairs of blob and rule version have been scanned and what was found.
A scan reads texts of unseen pairs only, one row for each distinct blob however
many paths or versions carry it; findings join back to every path.  On a first
load, when all blobs are unseen, a necessary condition of any finding is tested
where the texts lie, and only texts that meet it move to be scanned.  Everything
is DataFrame expressions; findings are offsets in code points, end exclusive.

A null text is the empty blob, a null path stays a path.  Repeated rows keep a
row each.  Empty tables give no rows.  Matches are leftmost and do not overlap
within a kind; a match that fails its length test is dropped, but consumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import scratch
from tidemark.llm.tables import table


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern that has one group, and how long the whole match or the group must be."""

    kind: str
    pattern: str
    least: int
    of_group: bool
    #: True of every text with a match that passes; cheap to test.
    hint: str


#: The base rules (fixed values).
BASE = (
    Rule(
        "assign",
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        True,
        r"""[DdTtNnYy]["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    ),
    # A run that is too short holds no passing match, so the length test is part of the pattern.
    Rule("access", r"(AKIA[A-Z0-9]{14,})", 18, False, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"([0-9a-f]{16,})", 16, False, r"[0-9a-f]{16}"),
)
VERSION = "base-1"

LEDGER = "blob string, rule_version string, findings array<struct<start:int,rank:int,end:int,kind:string>>"


#: Matches of one text that are put together at a time; work is linear in them but for this factor.
CHUNK = 256


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_chunks(items: Column, width, zero: Column, one) -> Column:
    """``one(chunk, offset)`` of every ``CHUNK`` items, the offset being what ``width`` carries over the chunks before.

    ``width(chunk, offset)`` is the offset behind a chunk."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda c: F.slice(items, c * CHUNK + 1, CHUNK))

    def placed(parts: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<int>").alias("before"))
        before = F.aggregate(parts, start, lambda acc, part: F.struct(width(part, acc["at"]).alias("at"), F.concat(acc["before"], F.array(acc["at"])).alias("before")), lambda acc: acc["before"])
        return F.zip_with(parts, before, one)

    return bound(chunks, placed)


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Passing matches of a rule as an array of ``start, end, rank, kind``.

    The pieces between matches and the matches themselves alternate, so running
    sums of their lengths are the offsets; they run over chunks of matches, so that
    a text of very many matches takes time in proportion to them.
    """
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    between = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.char_length)
    tested = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(1)), F.char_length) if rule.of_group else whole

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        hit = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + m["size"]).alias("end"), F.lit(rule.kind).alias("kind"))
        found = F.when(m["tested"] >= rule.least, F.concat(acc["found"], F.array(hit))).otherwise(acc["found"])
        return F.struct((start + m["size"]).alias("at"), found.alias("found"))

    def one(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, F.struct(at.alias("at"), empty.alias("found")), step, lambda acc: acc["found"])

    def behind(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, at, lambda acc, m: acc + m["gap"] + m["size"])

    matches = F.zip_with(F.arrays_zip(whole.alias("size"), tested.alias("tested")), F.slice(between, F.lit(1), F.size(whole)), lambda m, gap: F.struct(m["size"].alias("size"), m["tested"].alias("tested"), gap.alias("gap")))
    made = bound(matches, lambda m: F.when(F.size(m) > 0, F.flatten(in_chunks(m, behind, F.lit(0), one))).otherwise(empty))
    return F.when(F.regexp_like(text, F.lit(rule.hint)), made).otherwise(empty)


def hinted(text: Column, rules: tuple[Rule, ...] = BASE) -> Column:
    """A necessary condition of any finding."""
    out = F.lit(False)
    for r in rules:
        out = out | F.regexp_like(text, F.lit(r.hint))
    return out


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, ledger: DataFrame | None = None, path_col: str = "path", text_col: str = "text", rules: tuple[Rule, ...] = BASE, version: str = VERSION) -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger hasn't seen.

    ``versions`` has a row for every path and historical version of it.  Returns
    ``(findings, ledger)``, findings in the order of their starts, then of the rules: the first has ``path, blob, findings`` for every row of
    ``versions``, the second the ledger to keep (old and new pairs).
    """
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("blob", address(F.col("text")))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    # One place of each unseen blob: what is compared, grouped and joined are addresses, not texts.
    if ledger is None:
        current = None
        paths = scratch.materialise(rows.select("path", "blob", hinted(F.col("text"), rules).alias("hinted")))
        fresh = paths.groupBy("blob", "hinted").agg(F.min(F.struct(F.col("path").isNull().alias("none"), "path")).alias("place"))
        quiet = fresh.where("not hinted").select("blob", F.lit(version).alias("rule_version"), empty.alias("findings"))
        fresh, rows = fresh.where("hinted"), rows.where(hinted(F.col("text"), rules))
    else:
        current = ledger.where(F.col("rule_version") == version)
        paths, quiet = scratch.materialise(rows.select("path", "blob")), None
        places = paths.groupBy("blob").agg(F.min(F.struct(F.col("path").isNull().alias("none"), "path")).alias("place"))
        # Written first: where little is new, its known size spares the texts a shuffle.
        fresh = scratch.materialise(places.join(current.select("blob"), "blob", "left_anti"))
    fresh = fresh.select(F.col("blob").alias("b"), F.col("place.path").alias("p"))
    unseen = rows.join(fresh, (rows["blob"] == fresh["b"]) & rows["path"].eqNullSafe(fresh["p"]), "left_semi")
    found = F.array_sort(F.concat(*(spans(F.col("text"), r, k) for k, r in enumerate(rules))))
    # A path can hold a blob twice; its findings are the same, so any copy will do.
    scanned = unseen.select("blob", F.lit(version).alias("rule_version"), found.alias("findings"))
    scanned = scanned.groupBy("blob", "rule_version").agg(F.max("findings").alias("findings"))
    scanned = scratch.materialise(scanned if quiet is None else scanned.unionByName(quiet))
    known = scanned if current is None else current.unionByName(scanned)
    hits = known.where(F.size("findings") > 0).select("blob", "findings")
    joined = paths.join(hits, "blob", "left").select("path", "blob", F.coalesce("findings", empty).alias("findings"))
    return joined, (ledger.unionByName(scanned) if ledger is not None else scanned)


def listed(findings: Column) -> Column:
    """``kind:start:end`` of every finding by start, then rank, joined by commas."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")


def redact(text: Column, findings: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every finding, merged where they overlap, replaced by a mark; the text itself where there is none.

    The text is cut once for each chunk of findings, so no finding looks for its place in all of it."""

    def behind(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, at, lambda acc, f: F.greatest(acc, f["end"]))

    def one(chunk: Column, low: Column) -> Column:
        def cut(piece: Column) -> Column:
            def step(acc: Column, f: Column) -> Column:
                kept = F.substring(piece, acc["at"] - low + 1, F.greatest(f["start"] - acc["at"], F.lit(0)))
                out = F.when(f["start"] >= acc["at"], F.concat(acc["out"], kept, F.lit(mark))).otherwise(acc["out"])
                return F.struct(F.greatest(acc["at"], f["end"]).alias("at"), out.alias("out"))

            return F.aggregate(chunk, F.struct(low.alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])

        return bound(F.substring(text, low + 1, behind(chunk, low) - low), cut)

    tail = F.substring(text, behind(findings, F.lit(0)) + 1, F.char_length(text))
    return F.when(F.size(findings) > 0, F.concat(F.array_join(in_chunks(findings, behind, F.lit(0), one), ""), tail)).otherwise(text)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found, _ = scan(docs, path_col="doc_id")
    base = listed(F.filter("findings", lambda f: f["kind"].isin(*(r.kind for r in BASE))))
    kinds = [count_of(r.kind).alias(f"n_{r.kind}") for r in BASE]
    return found.select(F.col("path").alias("doc_id"), *kinds, F.sha2(base, 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))


def _sql_spans(rule: Rule, rank: int) -> str:
    """DuckDB: a row for each passing match of a rule."""
    pattern, hint = (x.replace("'", "''") for x in (rule.pattern, rule.hint))
    return f"""
a{rank} AS MATERIALIZED (SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS whole,
    regexp_extract_all(t, '{pattern}', {int(rule.of_group)}) AS tested FROM d WHERE regexp_matches(t, '{hint}')),
b{rank} AS (SELECT doc_id, unnest(list_transform(gaps[1:len(whole)], lambda x: length(x))) AS gap, unnest(list_transform(whole, lambda x: length(x))) AS size,
    unnest(list_transform(tested, lambda x: length(x))) AS tested, unnest(range(len(whole))) AS i FROM a{rank}),
c{rank} AS (SELECT doc_id, tested, size, sum(gap + size) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS e FROM b{rank}),
s{rank} AS (SELECT doc_id, e - size AS s, {rank} AS k, e, '{rule.kind}' AS kind FROM c{rank} WHERE tested >= {rule.least})"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {", ".join(_sql_spans(r, k) for k, r in enumerate(BASE))},
f AS ({" UNION ALL ".join(f"FROM s{k}" for k in range(len(BASE)))}),
g AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)} FROM f GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE)},
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""
