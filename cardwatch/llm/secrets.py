"""Operator 10: secret scan with corpus-wide ownership frequency; DataFrame functions only.

Three base patterns (assignments, access keys, hex runs) and two further ones (prefixed provider tokens, private
key blocks) give candidate spans. Every candidate value is hashed; over the whole corpus its distinct
repositories and owners are counted. A value of ``common_owners`` owners or more is a widely copied
example; other values with enough distinct characters are live-looking credentials of their owners.

In ``documents`` a document stands for a repository and ``source`` for its owner (both are parameters).

Defined results: NULL text counts as empty (no spans); a NULL repository or owner is not counted as one; spans are
code points, end exclusive, ordered by start and then by kind as listed; the same value twice in a document is two
spans but one repository; repeated rows are scanned alike, row by row; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table

# fixed values: the base patterns (kind, pattern, least length of the match or of group 2)
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"      # 18 characters or more
HEX = r"[0-9a-f]{16,}"
# added by the method
PROVIDER = r"\b(?:gh[pousr]_|glpat-|sk-|sk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}"
PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"

KINDS = ["assign", "access", "hex", "provider", "pem"]


@dataclass(frozen=True)
class SecretConfig:
    common_owners: int = 3         # owners that make a value a widely copied example
    least_distinct: int = 6        # distinct characters of a live-looking value
    repo: str = "doc_id"
    owner: str = "source"


#: matches of a text that are walked together
PART = 256


def cut(text: Column, pattern: str, group: int = 0, hint: Column | None = None) -> Column:
    """The text cut at the pattern's matches: structs (p: text before, m: match, v: the match's value), in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    rows = F.arrays_zip(F.split(text, pattern).alias("p"), found.alias("m"), value.alias("v"))
    test = text.rlike(pattern) if hint is None else hint & text.rlike(pattern)
    return F.when(test, rows).otherwise(F.array().cast("array<struct<p:string,m:string,v:string>>"))


def _length(r: Column) -> Column:
    return F.length(r["p"]) + F.coalesce(F.length(r["m"]), F.lit(0))


def _part(rows: Column, i: Column) -> Column:
    return F.slice(rows, i * PART + 1, F.lit(PART))


def part_starts(rows: Column) -> Column:
    """Where each part of PART matches starts in the text."""
    last = F.greatest(F.ceil(F.size(rows) / PART).cast("int") - 1, F.lit(0))
    lengths = F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(
        _part(rows, i), F.lit(0), lambda n, r: n + _length(r)))
    return F.aggregate(lengths, F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))


def spans(rows: Column, starts: Column, kind: int, least: int = 0) -> Column:
    """All leftmost non-overlapping matches as structs (s: start, k: kind, e: end, v: value), end exclusive.

    A match starts after the pieces and matches before it. They are summed up part by part, so that a text with very
    many matches is not copied once a match.
    """
    empty = F.array().cast("array<struct<s:int,k:int,e:int,v:string>>")

    def walk(i: Column) -> Column:
        zero = F.struct(F.element_at(starts, i + 1).alias("at"), empty.alias("out"))
        return F.aggregate(
            _part(rows, i), zero,
            lambda s, r: F.struct(
                (s["at"] + _length(r)).alias("at"),
                F.when(r["m"].isNull() | (F.length(r["v"]) < least), s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
                    (s["at"] + F.length(r["p"])).alias("s"), F.lit(kind).alias("k"),
                    (s["at"] + _length(r)).alias("e"), r["v"].alias("v"))))).alias("out")),
            lambda s: s["out"])

    return F.when(F.size(rows) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(starts) - 2), walk))).otherwise(empty)


def scan(docs: DataFrame, cfg: SecretConfig = SecretConfig()) -> DataFrame:
    """repo, owner and the ordered candidate spans of every document; one scan, no shuffle."""
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col(cfg.repo).cast("long").alias("doc_id"), F.col(cfg.owner).cast("string").alias("_o"),
                    t.alias("_t"))
    text = F.col("_t")
    least = {0: ASSIGN_LEAST}
    # column by column: each step reads the one before many times
    d = d.select("doc_id", "_o",
                 cut(text, ASSIGN, 2, text.contains(":") | text.contains("=")).alias("_r0"),
                 cut(text, ACCESS, hint=text.contains("AKIA")).alias("_r1"),
                 cut(text, HEX).alias("_r2"),
                 cut(text, PROVIDER, hint=text.rlike("[_-]|AIza")).alias("_r3"),
                 cut(text, PEM, hint=text.contains("-----BEGIN")).alias("_r4"))
    rows = [f"_r{k}" for k in range(len(KINDS))]
    d = d.select("doc_id", "_o", *rows, *[part_starts(F.col(r)).alias(f"_a{k}") for k, r in enumerate(rows)])
    found = [spans(F.col(r), F.col(f"_a{k}"), k, least.get(k, 0)) for k, r in enumerate(rows)]
    return d.select("doc_id", "_o", F.array_sort(F.concat(*found)).alias("_s"))


def joined(col: str, base_only: bool) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    s = F.filter(col, lambda x: x["k"] < 3) if base_only else F.col(col)
    return F.array_join(F.transform(s, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def ownership(scanned: DataFrame) -> DataFrame:
    """Each candidate value's hash with its distinct repositories and owners over the whole corpus.

    Repositories and owners are made distinct before they are counted, so a value that a third of all
    documents hold is summed by tasks, not gathered by one.
    """
    c = scanned.filter(F.size("_s") > 0).select("doc_id", "_o", F.explode(F.array_distinct(
        F.transform("_s", lambda x: F.sha2(x["v"].cast("binary"), 256)))).alias("_h"))
    repos = c.groupBy("_h", "doc_id").agg(F.lit(1).alias("x")).groupBy("_h").agg(
        F.count("doc_id").alias("n_repos"))
    owners = c.groupBy("_h", "_o").agg(F.lit(1).alias("x")).groupBy("_h").agg(F.count("_o").alias("n_owners"))
    return repos.join(owners, "_h")


def classify(scanned: DataFrame, cfg: SecretConfig = SecretConfig()) -> DataFrame:
    """Counts by class for each row (``_row``) that has a candidate: n_live and n_example spans, most repositories
    of a value."""
    one = scanned.filter(F.size("_s") > 0).select("_row", F.explode("_s").alias("_x")).select(
        "_row", F.sha2(F.col("_x.v").cast("binary"), 256).alias("_h"),
        (F.size(F.array_distinct(F.split(F.col("_x.v"), ""))) >= cfg.least_distinct).alias("_rich"))
    o = ownership(scanned)
    seen = one.join(o, "_h")
    example = F.col("n_owners") >= cfg.common_owners
    return seen.groupBy("_row").agg(
        F.sum(F.when(~example & F.col("_rich"), 1).otherwise(0)).cast("long").alias("n_live"),
        F.sum(F.when(example, 1).otherwise(0)).cast("long").alias("n_example"),
        F.max("n_repos").alias("max_repos"))


def report(docs: DataFrame, cfg: SecretConfig = SecretConfig()) -> DataFrame:
    # a row's number is written with it, so every row keeps its own verdict, whatever its doc_id
    scanned = keep(docs.sparkSession, scan(docs, cfg).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    seen = classify(scanned, cfg).withColumnRenamed("_row", "_d")

    def of_kind(k: int) -> Column:
        return F.size(F.filter("_s", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [of_kind(k) for k in range(3)]
    d = scanned.select("_row", "doc_id", *counts, F.sha2(joined("_s", True).cast("binary"), 256).alias("base_sha256"),
                       joined("_s", False).alias("spans"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_live", "n_example", "max_repos")]
    return d.join(seen, d["_row"] == seen["_d"], "left").select(*[c for c in d.columns if c != "_row"], *zero)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """DuckDB: matches numbered and summed up by windows, ownership by plain distinct counts."""
    patterns = [(ASSIGN, 2), (ACCESS, 0), (HEX, 0), (PROVIDER, 0), (PEM, 0)]
    parts = []
    for k, (pattern, group) in enumerate(patterns):
        p = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"SELECT row, doc_id, source, {k} AS k, string_split_regex(t, {p}) AS p, "
                     f"regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS v FROM t "
                     f"WHERE regexp_matches(t, {p})")
    cuts = " UNION ALL ".join(parts)
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    cfg = SecretConfig()
    return f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
cuts AS ({cuts}),
each AS (SELECT row, doc_id, source, k, i, length(p[i]) AS before, length(m[i]) AS size, v[i] AS v
         FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM cuts)),
placed AS (SELECT *, sum(before + size) OVER (PARTITION BY row, k ORDER BY i) AS e FROM each),
hits AS (SELECT row, doc_id, source, k, (e - size)::BIGINT AS s, e::BIGINT AS e, v FROM placed
         WHERE k <> 0 OR length(v) >= {ASSIGN_LEAST}),
owned AS (SELECT v, count(DISTINCT doc_id) AS n_repos, count(DISTINCT source) AS n_owners FROM hits GROUP BY v),
judged AS (SELECT h.*, o.n_repos, o.n_owners >= {cfg.common_owners} AS example,
                  len(list_distinct(string_split(h.v, ''))) >= {cfg.least_distinct} AS rich
           FROM hits h JOIN owned o ON o.v = h.v),
per_row AS (
  SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg({names}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base,
         string_agg({names}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
         count(*) FILTER (NOT example AND rich) AS n_live, count(*) FILTER (example) AS n_example,
         max(n_repos) AS max_repos
  FROM judged GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_example, 0) AS n_example, coalesce(max_repos, 0) AS max_repos
FROM t LEFT JOIN per_row r ON r.row = t.row"""


SQL = _sql()
