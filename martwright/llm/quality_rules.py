r"""Quality rules (native): a threshold table compiled into one projection.

Counts are built with array functions inside each row, so the job has no
shuffle and no user function: words, symbols, repeated lines and words in
repeated 3-word windows.  ``RULES`` names a ratio, a lower and an upper bound;
:func:`compile_rules` turns the table into columns of the same projection.

Defined results: a null or empty text has no words, all counts 0 and fails
the base rule (fewer than 50 words); repeated rows get equal results; every
input row gives one output row; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Common function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "as", "with", "be", "by",
    "this", "from", "or",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "qui", "est", "pour", "dans", "sur", "au",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht",
    "ein", "eine", "als", "er",
    "el", "los", "las", "y", "por", "con", "una", "su", "para", "es", "se", "del", "no", "lo",
)

#: ratio -> (smallest, largest) accepted value; None: no bound on that side.
RULES: dict[str, tuple[float | None, float | None]] = {
    "mean_word_length": (2.0, 15.0),
    "symbol_ratio": (None, 0.1),
    "stop_word_ratio": (0.02, None),
    "dup_line_ratio": (None, 0.5),
}


def compile_rules(ratios: dict[str, Column], rules: dict[str, tuple[float | None, float | None]]) -> Column:
    """All bounds of the table as one boolean column."""
    verdict = F.lit(True)
    for name, (low, high) in rules.items():
        if low is not None:
            verdict = verdict & (ratios[name] >= F.lit(low))
        if high is not None:
            verdict = verdict & (ratios[name] <= F.lit(high))
    return verdict


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")


def rule_counts(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of docs' columns) and the COUNTS."""
    d = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("_t"))
    d = d.select(
        "row",
        F.filter(F.split("_t", SPACE + "+"), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0).alias("_l"),
        F.length(F.translate("_t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    n = F.size("_w")
    d = d.select(
        "row", "word_chars", "n_symbols",
        n.cast("long").alias("n_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
        F.transform(
            F.slice("_w", 1, F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))).alias("_h"),
    )
    # only texts with a window that occurs twice go through the sort
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.withColumn("_s", F.when(twice, F.sort_array(
        F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    d = d.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda x, i: (x["h"] == F.get("_s", i - 1)["h"]) | (x["h"] == F.get("_s", i + 1)["h"])),
        lambda x: x["i"])))
    # each repeated window adds the words up to the next one, 3 at most
    covered = _sum(F.transform("_p", lambda x, i: F.least(
        F.lit(3), F.coalesce(F.get("_p", i + 1) - x, F.lit(3))).cast("long")))
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return d.select("row", *COUNTS)


def apply_rules(docs: DataFrame, rules: dict | None = None) -> DataFrame:
    """docs plus counts, ratios, ``base_failed`` and ``kept`` (these names
    replace docs' own)."""
    d = rule_counts(docs)
    words = F.greatest(F.col("n_words"), F.lit(1))
    ratios = {
        "mean_word_length": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "stop_word_ratio": F.col("n_stop_words") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = compile_rules(ratios, RULES if rules is None else rules)
    made = {**{c: F.col(c) for c in COUNTS}, **ratios, "base_failed": base, "kept": ~base & verdict}
    return d.select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in made),
                    *(c.alias(k) for k, c in made.items()))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's counts and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    r = RULES
    return rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (
  select rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
tri as (
  select rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] as g
  from (select rid, w, unnest(range(1, len(w) - 1)) as i from w)),
rep as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from tri) where c > 1),
cov as (
  select rid, count(distinct i + k) as n from rep, (select unnest(range(0, 3)) as k) group by rid),
c as (
  select w.doc_id, len(w.w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words,
    len(list_filter(w.w, lambda x: x in ({stops}))) as n_stop
  from w left join cov using (rid))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and word_chars / greatest(n_words, 1) between {r['mean_word_length'][0]} and {r['mean_word_length'][1]}
    and n_symbols / greatest(n_words, 1) <= {r['symbol_ratio'][1]}
    and n_stop / greatest(n_words, 1) >= {r['stop_word_ratio'][0]}
    and n_dup_lines / greatest(n_lines, 1) <= {r['dup_line_ratio'][1]} as kept
from (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from c)
"""
