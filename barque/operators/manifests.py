"""Manifests whose files carry their own hash (SRC9, AGG34, INC1, INC4).

A manifest is nested JSON. Its identity is the SHA-256 of its canonical form: keys sorted at every depth, no white space,
volatile fields and fields at their defaults left out. Files are read as whole texts, and the canonical form comes from the
text itself, so no schema has to be known: a field that a schema lacks still counts.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fields outside the identity, and the defaults at which a field is left out of it.
VOLATILE = ("adjustment_policy_verified", "artifact_sha256", "loader_version", "pull_run_id", "pulled_at")
DEFAULTS = {"closed_window_count": 0, "median_dollar_volume": 0.0, "price_side": "trade", "redistribution_class": "loader_manifest_private_cache"}
HASH = "manifest_sha256"
FIELDS = "artifact_path string, source string, market string, symbol string, frequency string, source_urls array<string>, source_sha256s array<string>, row_count long, first_ts long, last_ts long, adjustment_policy string, adjustment_policy_verified string"


def canonical(value) -> str:
    """JSON with keys sorted at every depth and no white space; characters beyond ASCII are escaped."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def identity_text(manifest: dict) -> str:
    """The canonical form of what identifies a manifest."""
    kept = {k: v for k, v in manifest.items() if k != HASH and k not in VOLATILE and not (k in DEFAULTS and v == DEFAULTS[k])}
    if kept.get("source_symbol") in ("", kept.get("symbol")):
        kept.pop("source_symbol", None)
    return canonical(kept)


@F.pandas_udf(StringType())
def _identity_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else identity_text(json.loads(t)))


@F.pandas_udf(StringType())
def _stamped_text(texts: pd.Series, verdicts: pd.Series) -> pd.Series:
    return pd.Series([canonical(json.loads(t) | {"adjustment_policy_verified": v}) for t, v in zip(texts, verdicts, strict=True)])


def checked(texts: DataFrame) -> DataFrame:
    """SRC9: (file, text), a row a manifest, to (file, FIELDS, identity, text, why): why is null for a sound one, and else
    not_json (no JSON object), edited (its own hash isn't that of its fields), unpaired (parallel lists of unequal length).
    A manifest without a recorded hash is not edited."""
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("text")).startswith("OBJECT"), F.lit(False))
    rows = texts.withColumn("json", F.when(is_object, F.col("text")))
    rows = rows.withColumn("identity", F.sha2(_identity_text("json"), 256)).withColumn("m", F.from_json("json", f"{FIELDS}, {HASH} string"))
    recorded = F.col(f"m.{HASH}")
    unpaired = ~F.coalesce(F.size("m.source_urls") == F.size("m.source_sha256s"), F.col("m.source_urls").isNull() & F.col("m.source_sha256s").isNull())
    why = F.when(F.col("json").isNull(), "not_json").when(recorded.isNotNull() & (recorded != F.col("identity")), "edited").when(unpaired, "unpaired")
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return rows.withColumn("why", why).select("file", *(f"m.{n}" for n in names), "identity", "text", "why")


def read_manifests(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC9: the sound manifests at path (file, FIELDS, identity, text), and the broken files with why (see `checked`). Each
    file is read whole, by one task; many small files are better packed."""
    rows = checked(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")))
    return rows.filter("why is null").drop("why"), rows.filter("why is not null").select("file", "why")


def pack(texts: DataFrame, path: str) -> None:
    """Manifests (file, text) as rows of Parquet files, many in one, whatever characters they hold: a store of a file for
    each manifest costs some milliseconds a file to write, list and open."""
    texts.select("file", "text").write.parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """`checked` over manifests that `pack` wrote, sound and broken in one pass."""
    return checked(spark.read.schema("file string, text string").parquet(path))


def stamped(manifests: DataFrame, source: str, verdict: str) -> tuple[DataFrame, DataFrame]:
    """INC4: the manifests' texts with the verdict in those of `source`, and one row of counts: stamped, already, skipped
    (another source), failed (the identity moved, so the text is left as it was; the field would not be volatile)."""
    own = F.col("source") == source
    todo = own & ~F.coalesce(F.col("adjustment_policy_verified") == verdict, F.lit(False))
    new = F.when(todo, _stamped_text(F.when(todo, F.col("text")).otherwise("{}"), F.lit(verdict)))
    rows = manifests.withColumn("new", new)
    moved = F.col("new").isNotNull() & (F.sha2(_identity_text(F.coalesce("new", F.lit("{}"))), 256) != F.col("identity"))
    status = F.when(~own, "skipped").when(~todo, "already").when(moved, "failed").otherwise("stamped")
    rows = rows.withColumn("status", status).withColumn("text", F.when(F.col("status") == "stamped", F.col("new")).otherwise(F.col("text"))).drop("new")
    counts = rows.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("stamped", "already", "skipped", "failed")))
    return rows, counts
