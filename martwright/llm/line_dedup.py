r"""Line dedup (native): removal of lines that spread over many sites.

Every line with a word is keyed by two 64-bit hashes of its trimmed text.
One aggregation per key merges a HyperLogLog sketch of the sites (``source``)
that carry it; keys whose estimate lies near the threshold get an exact
distinct count.  A line carried by ``min_sites`` sites or more is cross-site
boilerplate: all its occurrences but the first (smallest doc_id, then line
number) are removed, so that no line is lost to the corpus and a text that is
copied between sites survives once.  Lines on fewer sites stay.

Hot lines cost one partial row per input task (map-side merge); nothing is
collected.  DataFrame functions only.

Defined results: a null text stays null; a text without removed lines stays
byte for byte; a text whose lines all go becomes ''; lines without a word
stay; a null source is a site of its own; rows with equal doc_id and text
are treated alike; all columns are kept, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import with_text

MIN_SITES = 10
#: Estimates within this share of the threshold are counted exactly.
NEAR = 0.25
HLL_LG_K = 10


def _lines() -> Column:
    return F.split(F.col("text"), "\n", -1)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, site, pos, k1, k2) of every line with a word."""
    rows = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("th"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("site"),
        F.posexplode(F.transform(_lines(), lambda x: F.regexp_replace(
            x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))).alias("pos", "line"))
    return rows.where(F.col("line") != "").select(
        "doc_id", "th", "site", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"))


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(k1, k2, first) of the lines carried by ``min_sites`` sites or more."""
    lines = _keyed(docs)
    spread = lines.groupBy("k1", "k2").agg(
        F.hll_sketch_agg("site", HLL_LG_K).alias("sketch"),
        F.min(F.struct("doc_id", "pos")).alias("first"))
    spread = spread.select("k1", "k2", "first", F.hll_sketch_estimate("sketch").alias("sites")).where(
        F.col("sites") >= int(min_sites * (1 - NEAR)))
    near = F.col("sites") <= int(min_sites * (1 + NEAR)) + 1
    exact = (lines.join(spread.where(near).select("k1", "k2"), ["k1", "k2"], "left_semi")
             .groupBy("k1", "k2").agg(F.count_distinct("site").alias("exact")))
    return (spread.join(exact, ["k1", "k2"], "left")
            .where(F.coalesce("exact", "sites") >= min_sites).select("k1", "k2", "first"))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """docs with ``text`` rid of repeats of cross-site lines, plus
    ``n_lines`` and ``n_removed_lines``."""
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed_lines")]
    hits = (_keyed(docs).join(spread_lines(docs, min_sites), ["k1", "k2"])
            .where(~((F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("pos") == F.col("first.pos"))))
            .groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone")))
    d = docs.select(F.struct(*names).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), "text")
    d = d.join(hits, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th")), "left")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(
        F.filter(_lines(), lambda x, i: ~F.array_contains("gone", i)), "\n"))
    return d.select(
        *(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names),
        F.coalesce(F.size(_lines()), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed_lines"))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's line counts and remaining text's hash."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without repeated cross-site lines."""
    return dedup_lines(docs).select(*with_text(docs.columns, F.col("text"), F.col("n_removed_lines") > 0))


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    return rf"""
with d as (select row_number() over () as rid, doc_id, source, text from documents),
l as (
  select rid, doc_id, source, unnest(string_split(text, chr(10))) as line,
    unnest(range(0, len(string_split(text, chr(10))))) as pos from d where text is not null),
k as (
  select rid, doc_id, coalesce(source, chr(0)) as site, pos, line,
    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as key from l),
b as (
  select key, min(struct_pack(doc_id := doc_id, pos := pos)) as first from k where key <> ''
  group by key having count(distinct site) >= {MIN_SITES}),
m as (
  select rid, pos, line, b.key is not null and not (doc_id = b.first.doc_id and pos = b.first.pos) as gone
  from k left join b on k.key = b.key),
t as (
  select rid, count(*) as n_lines, sum(gone::int) as n_removed,
    coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as kept from m group by rid)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed_lines,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join t using (rid)
"""
