"""Secret scans over an incremental blob ledger, DataFrame functions only (operator 6).

Every version of every path is addressed by the SHA-256 of its text. A row of the ledger says under which rule versions a
blob was scanned, and what was found. A scan takes one path for each blob, runs on its text the rule versions that the
ledger lacks for it, and gives new rows for the ledger; findings are joined back to all paths by blob. Copies and versions
seen before cost no scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barque.llm.storage import stored


@dataclass(frozen=True)
class Rule:
    """kind: its name in spans. pattern: Java regular expression. guard: cheap test that every match passes. group and
    least: the group whose length counts, and the least length."""

    kind: str
    version: int
    pattern: str
    guard: str
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""(?i)(?:word|passwd|secret|token|key)["']?\x20*[:=]""", 2, 8, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA", 0, 16, True),
    Rule("hex", 1, r"[0-9a-f]+", r"[0-9a-f]{32}", 0, 32, True),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ"),
    Rule("key_block", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN "),
    Rule("hub_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-"),
)
SPANS = "array<struct<start:int,end:int>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans (code points, end exclusive) of the leftmost non-overlapping matches whose counted group is long enough.

    The text between matches and the matches themselves alternate, so their running lengths are the places."""
    pattern = F.lit(rule.pattern)

    def placed(both: Column) -> Column:
        state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(SPANS).alias("found"))

        def step(s: Column, m: Column) -> Column:
            start = s["at"] + F.length(F.get(both["between"], s["i"]))
            end = start + F.length(m)
            counted = F.length(F.regexp_extract(m, rule.pattern, rule.group)) if rule.group else F.length(m)
            found = F.when(counted >= rule.least, F.concat(s["found"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(s["found"])
            return F.struct(end.alias("at"), (s["i"] + 1).alias("i"), found.alias("found"))

        return F.aggregate(both["matches"], state, step, lambda s: s["found"])

    both = F.struct(F.split(text, rule.pattern, -1).alias("between"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches"))
    return F.when(text.rlike(rule.guard), F.get(F.transform(F.array(both), placed), F.lit(0))).otherwise(F.array().cast(SPANS))


FOUND = f"array<struct<rule:string,spans:{SPANS}>>"
LEDGER = f"blob binary, scanned array<string>, found {FOUND}"


def address(versions: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """The path's id, for a null one a number before all others from its text, and the text's SHA-256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.lit(-(1 << 63)) + F.pmod(F.xxhash64(text), F.lit(1 << 40))
    return F.coalesce(F.col(id_col).cast("long"), own), F.unhex(F.sha2(text, 256))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The paths (doc_id, id, blob) of one increment, and the rows that it adds to the ledger.

    versions: any number of rows per path (id); a null text counts as empty. ledger: the rows of earlier scans (LEDGER).
    Repeated rows and copies have one blob and one scan; a null id stays null, its `id` comes from the text, so that texts
    under null ids don't meet; an empty table gives no rows; other columns are ignored.
    """
    id_, blob = address(versions, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = versions.select(F.col(id_col).cast("long").alias("doc_id"), id_.alias("id"), blob.alias("blob"), text.alias("text"))
    paths = stored(rows.select("doc_id", "id", "blob"), "paths")
    chosen = paths.groupBy("blob").agg(F.min("id").alias("id"))
    keys = F.array(*(F.lit(r.key) for r in rules))
    if ledger is None:
        chosen = chosen.withColumn("todo", keys)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
        todo = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
        chosen = chosen.join(seen, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0).drop("seen")
    # by id and blob: ids spread evenly, whatever a blob's copies; a hash join needs no sort of the texts
    todo = rows.select("id", "blob", "text").join(chosen.hint("shuffle_hash"), ["id", "blob"])
    if not paths.groupBy("id", "blob").count().filter("count > 1").isEmpty():
        todo = todo.dropDuplicates(["id", "blob"])
    found = F.array(*(F.struct(F.lit(r.key).alias("rule"), F.when(F.array_contains("todo", r.key), spans_of(F.col("text"), r)).alias("spans")) for r in rules))
    return paths, stored(todo.select("blob", F.col("todo").alias("scanned"), F.filter(found, lambda x: F.size(x["spans"]) > 0).alias("found")), "ledger")


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, id, blob and, for each rule, spans_<kind> of every path, each of which was scanned."""
    hits = ledger.filter(F.size("found") > 0).groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    of = lambda r: F.coalesce(F.get(F.filter("found", lambda x: x["rule"] == r.key), F.lit(0))["spans"], F.array().cast(SPANS))
    return paths.join(hits, "blob", "left").select("doc_id", "id", "blob", *(of(r).alias(f"spans_{r.kind}") for r in rules))


def joined(rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans, by start, then in the order of the rules, comma-joined."""

    def named(i: int, r: Rule) -> Column:
        return F.transform(f"spans_{r.kind}", lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("order"), x["end"].alias("end"), F.lit(r.kind).alias("kind")))

    each = [named(i, r) for i, r in enumerate(rules)]
    return F.array_join(F.transform(F.array_sort(F.concat(*each)), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]", prefix: str = "spans_") -> Column:
    """text with every span of the columns <prefix><kind> replaced; spans that touch or overlap become one mask."""
    spans = F.array_sort(F.concat(*(F.col(f"{prefix}{r.kind}") for r in rules)))
    none = F.array().cast(SPANS)

    def step(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(x["start"] <= last["end"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(x)))

    def pieces(apart: Column) -> Column:
        """The text before each span, and after the last."""
        ends = F.concat(F.array(F.lit(0)), apart["end"])
        starts = F.concat(apart["start"], F.array(F.length(text)))
        return F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a))

    whole = F.get(F.transform(F.array(F.aggregate(spans, none, step)), lambda apart: F.array_join(pieces(apart), mask)), F.lit(0))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def op6_secrets(spark, sf_dir: str) -> DataFrame:
    """Two increments of the history, dealt by a hash of the id, the second behind the ledger of the first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    second = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    paths, ledger = scan(docs.filter(~second))
    more_paths, more = scan(docs.filter(second), ledger)
    found = findings(paths.unionByName(more_paths), ledger.unionByName(more))
    base = tuple(r for r in RULES if r.base)
    return found.select("doc_id", *(F.size(f"spans_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in base), F.sha2(joined(base), 256).alias("base_sha256"), joined(RULES).alias("spans"))
