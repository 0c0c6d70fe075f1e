"""Secret scans over an incremental ledger of blobs.

Texts are content-addressed: a blob is the SHA-256 of its bytes, so copies and
versions that come back are one blob. The ledger holds the (blob, rule, rule
version) triples scanned so far with their hits. A run scans unseen triples
only, and findings go back to all paths through the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import bound, match_spans, running, skew_join, spans_text
from aerolag.sources.stage import Stages


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``hint``: a cheap pattern found in every text with a hit."""

    name: str
    version: int
    pattern: str
    hint: str
    least: int = 0  # characters that the match, or its group, must have
    group: int = 0


BASE = (
    Rule("assign", 1, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", 6, 1),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", 20),
    Rule("hex", 1, r"[0-9a-f]+", r"[0-9a-f]{24}", 24),
)
# Spans beyond the base kinds: private key blocks, signed web tokens, credentials in addresses.
EXTRA = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
         r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}"),
    Rule("userinfo", 1, r"[a-z][a-z0-9+]{1,15}://[^\s/:@?#]{1,64}:[^\s/:@?#]{6,128}@", r"://[^\s/:@?#]+:[^\s/:@?#]+@"),
)
RULES = BASE + EXTRA
SPAN = "struct<start:int,end:int,kind:string,hit:string,part:string>"
LEDGER = f"blob binary, rule string, version int, hits array<{SPAN}>"


def blob_id(text: Column) -> Column:
    """Content address; a null text is the empty blob."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def rule_hits(text: Column, rule: Rule) -> Column:
    pattern = rule.pattern
    # A run of hex digits shorter than asked never holds a longer one, so the
    # run length can stand in the pattern; other rules drop short hits afterwards.
    if rule.name == "hex":
        pattern = rf"[0-9a-f]{{{rule.least},}}"
    found = match_spans(text, pattern, rule.name, rule.group)
    if rule.least:
        found = F.filter(found, lambda s: F.length(s["part"]) >= rule.least)
    return F.when(text.rlike(rule.hint), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(versions: DataFrame, text_col: str, ledger: DataFrame | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rule, version, hits) of unseen triples.

    ``versions`` holds every version of every path, copies included; a blob is
    scanned once. An empty input or one that the ledger covers gives no rows.
    """
    names = [f"{r.name}:{r.version}" for r in rules]
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = versions.select(blob_id(F.col(text_col)).alias("blob"), text.alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is not None:
        seen = ledger.select("blob", F.concat_ws(":", "rule", "version").alias("name")).where(F.col("name").isin(names))
        seen = seen.groupBy("blob").agg(F.collect_set("name").alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
    else:
        blobs = blobs.withColumn("seen", F.lit(None).cast("array<string>"))
    todo = [~F.coalesce(F.array_contains("seen", n), F.lit(False)) for n in names]
    rows = F.array(*[
        F.when(new, F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                             rule_hits(F.col("text"), r).alias("hits")))
        for new, r in zip(todo, rules)
    ])
    fresh = blobs.select("blob", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x"))
    return fresh.select("blob", "x.rule", "x.version", "x.hits")


def with_hits(versions: DataFrame, blob: Column, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add __hits: the hits of a row's blob under the given rules, empty where none.

    Blobs with hits may hold many paths. Their paths are counted before any
    shuffle, and blobs with very many are broadcast.
    """
    current = F.concat_ws(":", "rule", "version").isin([f"{r.name}:{r.version}" for r in rules])
    hit = ledger.where(current & (F.size("hits") > 0)).groupBy(F.col("blob").alias("__blob")).agg(
        F.flatten(F.collect_list("hits")).alias("__hits"))
    paths = versions.withColumn("__blob", blob)
    sizes = paths.groupBy("__blob").agg(F.count("*").alias("__n"))
    hit = Stages(versions.sparkSession).put(hit.join(sizes, "__blob"), "hits")
    found = skew_join(paths, hit, "__blob", "__n", "left")
    return found.withColumn("__hits", F.coalesce("__hits", F.array().cast(f"array<{SPAN}>"))).drop("__blob")


def findings(versions: DataFrame, id_col: str, text_col: str, ledger: DataFrame,
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, hits) of every version. Rows that repeat are kept."""
    paths = versions.select(F.col(id_col).alias("id"), blob_id(F.col(text_col)).alias("blob"))
    return with_hits(paths, F.col("blob"), ledger, rules).select("id", F.col("__hits").alias("hits"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, hits) of every row, over a ledger that starts empty."""
    ledger = Stages(docs.sparkSession).put(scan(docs, text_col, None, rules), "ledger")
    return findings(docs, id_col, text_col, ledger, rules)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and the joined spans of the base kinds, and all spans."""
    base, every = [r.name for r in BASE], [r.name for r in RULES]
    def of(kinds: list[str]) -> Column:
        return F.filter("hits", lambda s: s["kind"].isin(kinds))

    return found.select(
        F.col("id").alias(id_col),
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(spans_text(of(base), every), 256).alias("base_sha256"),
        spans_text(F.col("hits"), every).alias("spans"),
    )


def redact(text: Column, hits: Column, mark: str = "[SECRET]") -> Column:
    """The text with each group of touching or overlapping spans replaced by one mark."""
    spans = F.array_sort(F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def cover(at: Column, s: Column) -> Column:
        return F.greatest(at, s["end"])

    def joined(spans: Column, part) -> Column:
        """Kept pieces and marks; ``part(at, n)`` is a piece of the text."""
        def pieces(ends: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
            kept = F.zip_with(spans, before, lambda s, at: F.when(
                (s["start"] > at) | (at == 0), F.concat(part(at, s["start"] - at), F.lit(mark))).otherwise(""))
            return F.concat(kept, F.array(part(F.element_at(ends, -1), F.length(text))))

        return F.array_join(bound(running(spans, F.lit(0), cover), pieces), "")

    def piece(at: Column, n: Column) -> Column:
        return F.substring(text, at + 1, F.greatest(n, F.lit(0)))

    def from_characters(spans: Column) -> Column:
        # Finding a place in a text takes time in proportion to it; characters in an array are at hand.
        return bound(F.split(text, ""), lambda chars: joined(
            spans, lambda at, n: F.array_join(F.slice(chars, at + 1, F.greatest(n, F.lit(0))), "")))

    done = bound(spans, lambda x: F.when(F.size(x) > 64, from_characters(x)).otherwise(joined(x, piece)))
    return F.when(F.size(hits) == 0, text).otherwise(done)


def redact_documents(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns, with secrets replaced in the text; a null text stays null."""
    ledger = Stages(docs.sparkSession).put(scan(docs, text_col, None, rules), "ledger")
    found = with_hits(docs, blob_id(F.col(text_col)), ledger, rules)
    return found.withColumn(text_col, redact(F.col(text_col), F.col("__hits"))).select(*docs.columns)
