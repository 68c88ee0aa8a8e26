"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger, a Parquet table of (blob, rule, version,
spans), tells which rule versions have seen which blob; a run scans only the missing pairs, one carrier text for each
blob, appends what it found (also nothing found) and joins the findings back to all paths that hold the blob. Text is
shuffled once, after copies are combined within each task, so a blob that a third of all rows hold is no hot key; the
join back carries hashes and short spans only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import scratch, table


@dataclass(frozen=True)
class Rule:
    """gate: cheap necessary condition; group of pattern must have at_least characters, else the match is dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    at_least: int
    gate: str


#: The base rules, in the order in which equal starts are listed.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, r"(?i)passw|secret|token|api_?key"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, r"AKIA"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32}"),
)
_SPANS = "array<struct<s:int,e:int>>"
LEDGER = f"blob string, rule string, version int, spans {_SPANS}"


def find(text: F.Column, rule: Rule) -> F.Column:
    """Spans (start, end exclusive, in code points) of the leftmost non-overlapping matches that don't fail."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    steps = F.zip_with(
        F.slice(between, 1, F.size(whole)),
        F.arrays_zip(whole.alias("w"), value.alias("v")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("n"), F.length(m["v"]).alias("v")),
    )
    found = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["n"]).alias("at"),
            F.when(
                x["v"] >= rule.at_least,
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + x["gap"]).alias("s"), (acc["at"] + x["gap"] + x["n"]).alias("e")))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    return F.when(F.regexp_like(text, F.lit(rule.gate)), found).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(docs: DataFrame, ledger: str, rules=RULES, text: str = "text") -> None:
    """Scan the (blob, rule version) pairs of docs that the ledger at that path lacks and append them.

    A null text is the empty blob. Running it again over the same rows appends nothing; a batch that failed half-way
    leaves no committed rows, so it is simply run again."""
    spark = docs.sparkSession
    blobs = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select(F.sha2("text", 256).alias("blob"), "text")
    seen = read_ledger(spark, ledger).select("blob", "rule", "version").distinct()
    if seen.isEmpty():
        todo = blobs.dropDuplicates(["blob"]).withColumn("done", F.expr("cast(array() as array<string>)"))
    else:
        done = seen.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("done"))
        todo = blobs.dropDuplicates(["blob"]).join(done, "blob", "left")
        todo = todo.withColumn("done", F.coalesce("done", F.expr("cast(array() as array<string>)")))
    found = todo.select(
        "blob",
        F.explode(
            F.array_compact(
                F.array(
                    *(
                        F.when(
                            ~F.array_contains("done", f"{r.kind}:{r.version}"),
                            F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), find(F.col("text"), r).alias("spans")),
                        )
                        for r in rules
                    )
                )
            )
        ).alias("x"),
    ).select("blob", "x.*")
    found.write.mode("append").parquet(ledger)


def findings(docs: DataFrame, ledger: str, rules=RULES, text: str = "text") -> DataFrame:
    """docs with n_<kind> for each rule, and spans: an array of (start, order of the rule, end, kind), by start and rule.

    Rows with equal texts get equal findings; null and empty texts have none. Columns of docs with these names are
    replaced, and one named _blob is lost."""
    names = [f"n_{r.kind}" for r in rules] + ["spans"]
    current = read_ledger(docs.sparkSession, ledger).where(F.size("spans") > 0).where(
        F.concat_ws(":", "rule", "version").isin([f"{r.kind}:{r.version}" for r in rules])
    ).dropDuplicates(["blob", "rule"])
    rank = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    tagged = current.select(
        F.col("blob").alias("_blob"), "rule",
        F.transform("spans", lambda x: F.struct(x["s"].alias("s"), rank[F.col("rule")].alias("k"), x["e"].alias("e"), F.col("rule").alias("kind"))).alias("t"),
    )
    by_blob = tagged.groupBy("_blob").agg(F.sort_array(F.flatten(F.collect_list("t"))).alias("spans"))
    paths = docs.drop(*names).withColumn("_blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    out = paths.join(by_blob, "_blob", "left").drop("_blob")
    out = out.withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<s:int,k:int,e:int,kind:string>>)")))
    return out.withColumns({f"n_{r.kind}": _count(i) for i, r in enumerate(rules)})


def _count(rank: int) -> F.Column:
    return F.size(F.filter("spans", lambda x: x["k"] == rank)).cast("long")


def secret_scan(docs: DataFrame, ledger: str | None = None, rules=RULES, text: str = "text") -> DataFrame:
    """Bring the ledger (a new one in the shared folder by default) up to date with docs and give their findings."""
    ledger = ledger or scratch(docs.sparkSession, "blob-ledger")
    update_ledger(docs, ledger, rules, text)
    return findings(docs, ledger, rules, text)


def span_text(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(text: F.Column, spans: F.Column) -> F.Column:
    """text with every maximal run of overlapping spans replaced by <secret>; spans ordered by start."""
    merged = F.aggregate(
        spans,
        F.expr(f"cast(array() as {_SPANS})"),
        lambda runs, x: F.when(
            (F.size(runs) > 0) & (x["s"] < F.element_at(runs, -1)["e"]),
            F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(F.element_at(runs, -1)["s"].alias("s"), F.greatest(F.element_at(runs, -1)["e"], x["e"]).alias("e")))),
        ).otherwise(F.concat(runs, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))),
    )
    edge = F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e")))
    end = F.array(F.struct(F.length(text).alias("s"), F.length(text).alias("e")))
    pieces = F.zip_with(F.concat(edge, merged), F.concat(merged, end), lambda a, b: F.substring(text, a["e"] + 1, b["s"] - a["e"]))
    return F.when(F.size(spans) > 0, F.array_join(pieces, "<secret>")).otherwise(text)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = secret_scan(docs).withColumn("spans", span_text(F.col("spans")))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")


def _rule_sql(i: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {i} AS k, '{kind}' AS kind, s, s + n AS e FROM (
    SELECT doc_id, unnest(w) AS m, unnest(v) AS v, unnest(list_transform(range(1, len(w) + 1), lambda j:
        list_sum(list_transform(g[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:j-1], lambda x: length(x))), 0))) AS s, length(m) AS n
    FROM (SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS w, regexp_extract_all(text, '{p}', {group}) AS v, string_split_regex(text, '{p}') AS g
          FROM t WHERE regexp_matches(text, '{p}'))) WHERE length(v) >= {least}"""


_ANY_CASE = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
OP3_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join((_rule_sql(0, "assign", _ANY_CASE + r'''["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)''', 2, 8), _rule_sql(1, "access", "AKIA[A-Z0-9]+", 0, 16), _rule_sql(2, "hex", "[0-9a-f]+", 0, 32)))}),
a AS (SELECT doc_id, count_if(k = 0) AS n_assign, count_if(k = 1) AS n_access, count_if(k = 2) AS n_hex,
        string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) AS spans FROM f GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a USING (doc_id)
"""
