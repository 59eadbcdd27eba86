"""Secret scans over a ledger of content-addressed blobs, in DataFrame operations only.

Every version of every path is named by the digest of its text. Only (blob, rule, version of the rule) triples that the ledger
does not hold are scanned, each blob once however many paths carry it; findings are then joined back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiforge.storage import materialize, new_path

SPANS = "array<struct<start: int, rank: int, end: int, kind: string>>"
SEEN = "array<struct<kind: string, version: int>>"
LEDGER = f"blob binary, rules {SEEN}, spans {SPANS}"
#: Matches of a text that are gathered in one step.
CHUNK = 256


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` are dropped.

    The pattern matches no empty string and looks neither before nor behind itself.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1


ASSIGN_WORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE_RULES = [
    Rule("assign", rf"({ASSIGN_WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
]
EXTRA_RULES = [
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
]
RULES = BASE_RULES + EXTRA_RULES


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(text: str, rule: Rule, rank: int) -> Column:
    """Spans of a rule in the string column named ``text``; ends are exclusive, in code points.

    What lies between the matches, and the matches, follow each other without a gap, so their lengths add up to positions.
    Spans are gathered in chunks, and the chunks in a second step, so that very many matches of one text cost little more than each alone.
    """
    p = _quoted(rule.pattern)
    found = f"regexp_extract_all({text}, {p}, 0)"
    judged = found if not rule.group else f"regexp_extract_all({text}, {p}, {rule.group})"
    # The last gap has no match behind it: slice() takes it away before the arrays are zipped.
    zipped = f"zip_with(slice(split({text}, {p}, -1), 1, size({found})), zip_with({found}, {judged}, (h, j) -> struct(length(h) as hit, length(j) >= {rule.least} as good)), (g, m) -> struct(length(g) as gap, m.hit as hit, m.good as good))"
    one = f"struct(a.at + m.gap as start, {rank} as rank, a.at + m.gap + m.hit as end, '{rule.kind}' as kind)"
    gather = f"(a, m) -> struct(a.at + m.gap + m.hit as at, if(m.good, concat(a.spans, array({one})), a.spans) as spans)"
    chunks = f"transform(sequence(0, (size(z) - 1) div {CHUNK}), k -> slice(z, k * {CHUNK} + 1, {CHUNK}))"
    none = f"cast(array() as {SPANS})"
    in_chunk = f"aggregate(c, struct(t.at as at, {none} as spans), {gather})"
    each = f"aggregate({chunks}, struct(0 as at, {none} as spans), (t, c) -> element_at(transform(array({in_chunk}), r -> struct(r.at as at, concat(t.spans, r.spans) as spans)), 1), t -> t.spans)"
    all_spans = f"element_at(transform(array({zipped}), z -> {each}), 1)"
    return F.expr(f"case when regexp({text}, {_quoted(_probe(rule))}) then {all_spans} else {none} end")


def _probe(rule: Rule) -> str:
    """A pattern that every text with a good match has; it spares the other texts the rest."""
    return rule.pattern[:-1] + f"{{{rule.least},}}" if rule.kind == "hex" and rule.pattern.endswith("]+") else rule.pattern


def blobs_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(path, blob, text): null texts count as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("path"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))


def _named(rules: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules: list[Rule]) -> DataFrame:
    """(blob, rules, spans) of blobs that lack a rule's version in the ledger: what was scanned now, and the findings of it.

    Texts are scanned where they are read and never shuffled: against an empty ledger every version is scanned and equal blobs
    meet only as findings; else the unseen blobs are picked by digest first, and the texts join them (Spark broadcasts them if they are few).
    """
    wanted, nothing = _named(rules), F.expr(f"cast(array() as {SPANS})")
    if ledger is None:
        texts = versions.select("blob", "text", wanted.alias("rules"))
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
        lacks = F.array_except(wanted, F.coalesce("seen", F.expr(f"cast(array() as {SEEN})")))
        unseen = versions.select("blob").distinct().join(seen, "blob", "left").select("blob", lacks.alias("rules")).where("size(rules) > 0")
        texts = versions.select("blob", "text").join(materialize(unseen, "unseen"), "blob")
    parts = [F.when(F.array_contains("rules", F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))), spans_of("text", r, k)).otherwise(nothing) for k, r in enumerate(rules)]
    return texts.select("blob", "rules", F.array_sort(F.concat(*parts)).alias("spans")).groupBy("blob").agg(F.first("rules").alias("rules"), F.first("spans").alias("spans"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, ledger_path: str | None = None) -> DataFrame:
    """(path, spans) for every row of ``docs``; spans by start, then in the order of the rules.

    The ledger at ``ledger_path`` is read if it exists, only what it lacks is scanned, and that is appended to it; without a path
    a new one is made in the shared folder. Findings come from the ledger. What two writers append at once may stand there twice and
    counts once. Null and empty texts have no spans. Repeated rows and null ids each give a row; other columns are not read; an empty
    table gives an empty result.
    """
    rules = RULES if rules is None else rules
    spark = docs.sparkSession
    ledger_path = ledger_path or new_path(spark, "ledger")
    versions = blobs_of(docs, id_col, text_col)
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    scan_unseen(versions, spark.read.schema(LEDGER).parquet(ledger_path) if there else None, rules).write.mode("append").parquet(ledger_path)
    hits = spark.read.schema(LEDGER).parquet(ledger_path).where("size(spans) > 0").withColumn("good", F.array_intersect("rules", _named(rules)))
    ranks = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    spans = F.transform(F.expr("filter(spans, s -> exists(good, g -> g.kind = s.kind))"), lambda s: F.struct(s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    # A set of lists, then a set of spans: rows that were appended twice count once.
    found = hits.select("blob", spans.alias("spans")).groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"))
    return versions.select("path", "blob").join(found, "blob", "left").select("path", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def span_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row."""
    base = F.expr("filter(spans, s -> s.kind in ('assign', 'access', 'hex'))")
    found = scan_secrets(docs, id_col, text_col).withColumn("base", base)
    count = lambda kind: F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")
    return found.select(F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
