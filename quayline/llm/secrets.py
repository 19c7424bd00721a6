"""Secrets and who owns them.

Patterns find candidates in the texts. Each candidate value is hashed, and over the whole corpus it is counted in how
many distinct repositories and by how many distinct owners it is used. A value that many owners have is a copied example;
one that belongs to one or two looks live. Long tokens of mixed characters, which no pattern names, are candidates too;
they become findings if a single owner has them.

Everything is SQL functions. The places of matches come from the gaps between them: a text split at a pattern gives the
gaps, and running sums over gaps and matches give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import Window as W

from quayline.llm.common import table, whole_text, written

#: Kind, pattern, group that holds the value, least characters of the value; in the order of equal starts.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # a run of 24 or more is the same run that one of any length is
)
OWNED = ("owned", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
EXAMPLE_OWNERS = 3  # a value that so many owners use is an example


def _matches(text: Column, at: int, kind: str, pattern: str, group: int) -> Column:
    """Per match of a pattern its kind, number, the characters since the match before, length and value."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    return F.when(F.size(found) > 0, F.transform(
        F.arrays_zip(found.alias("found"), values.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap")),
        lambda m: F.struct(F.lit(at).alias("at"), F.lit(kind).alias("kind"), F.length(m["gap"]).alias("gap"),
                           F.length(m["found"]).alias("length"), m["value"].alias("value"))))


def candidates(docs: DataFrame, repository: str, owner: str, text: str) -> tuple[DataFrame, DataFrame]:
    """One row per document, and one per candidate with ``start``, ``end`` and the hash of its value."""
    body = F.col("_text")
    found = F.concat(*[F.coalesce(_matches(body, i, kind, pattern, group), F.array().cast(
        "array<struct<at:int,kind:string,gap:int,length:int,value:string>>"))
        for i, (kind, pattern, group, _) in enumerate((*BASE, OWNED))])
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(f"`{repository}`").alias("_repository"),
        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("_owner"),
        whole_text(f"`{text}`").alias("_text"))
        .select("_row", "_repository", "_owner", found.alias("_found")), "candidates")
    each = rows.where(F.size("_found") > 0).select("_row", "_repository", "_owner", F.posexplode("_found").alias("_n", "_m"))
    so_far = W.partitionBy("_row", "_m.at").orderBy("_n")
    before = F.sum(F.col("_m.gap") + F.col("_m.length")).over(so_far)
    least = F.element_at(F.array(*[F.lit(m) for *_, m in (*BASE, OWNED)]), F.col("_m.at") + 1)
    mixed = F.col("_m.value").rlike("[a-z]") & F.col("_m.value").rlike("[A-Z]") & F.col("_m.value").rlike("[0-9]")
    spans = (each.withColumn("_end", before)
             .where((F.length("_m.value") >= least) & ((F.col("_m.at") < len(BASE)) | mixed))
             .select("_row", "_repository", "_owner", F.col("_m.at").alias("at"), F.col("_m.kind").alias("kind"),
                     (F.col("_end") - F.col("_m.length")).alias("start"), F.col("_end").alias("end"),
                     F.unhex(F.sha2("_m.value", 256)).alias("value_hash")))
    return rows, spans


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash how many distinct owners and repositories have it, summed in three steps that a hot value, too,
    leaves one row per task for."""
    return (spans.groupBy("value_hash", "_owner", "_repository").agg(F.count(F.lit(1)).alias("uses"))
            .groupBy("value_hash", "_owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("uses").alias("uses"))
            .groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"),
                                       F.sum("uses").alias("uses")))


def find_secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source", text: str = "text",
                 example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per document: ``repository`` and ``findings``, an array by start and kind.

    A finding has kind, start and end (code points, end exclusive), value_hash, owners, repositories and ``live``: fewer
    than ``example_owners`` owners have the value. Values of the mixed-token kind are findings if one owner has them and
    they touch no other finding. A NULL text is empty, a NULL owner one owner without a name, NULL repositories are one.
    Repeated rows give repeated results and count once as a repository. No rows give no rows; other columns play no part.
    """
    rows, spans = candidates(docs, repository, owner, text)
    spans = written(spans, "spans")
    counted = spans.join(ownership(spans), "value_hash")
    listed = counted.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "at", "kind", "end", "value_hash", "owners", "repositories",
        (F.col("owners") < example_owners).alias("live")))).alias("_all"))
    base = F.filter("_all", lambda s: s["at"] < len(BASE))
    kept = F.filter("_all", lambda s: (s["at"] < len(BASE)) | ((s["owners"] == 1) & ~F.exists(
        F.col("_base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    none = F.array().cast(
        "array<struct<start:bigint,at:int,kind:string,end:bigint,value_hash:binary,owners:bigint,repositories:bigint,"
        "live:boolean>>")
    found = listed.withColumn("_base", base).select("_row", kept.alias("_kept"))
    return (rows.select("_row", "_repository").join(found, "_row", "left")
            .select(F.col("_repository").alias(repository), F.coalesce("_kept", none).alias("findings")))


def _places(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, and how many of them look live."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")
    live = F.size(F.filter("findings", lambda s: s["live"])).cast("long")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(_places(F.filter("findings", lambda s: s["at"] < len(BASE))), 256).alias("base_sha256"),
        _places(F.col("findings")).alias("spans"), live.alias("n_live"),
        (F.size("findings").cast("long") - live).alias("n_example"))
