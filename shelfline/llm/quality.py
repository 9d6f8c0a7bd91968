"""Rule bitmask ledger (quality rules).

Every rule is evaluated once for a document. The ledger row holds the
measurements and one ``failed`` long whose bit *i* says that rule *i* failed.
Policies are versioned sets of rules (a bit mask); applying one, or comparing
many, is bitwise arithmetic on the ledger and never looks at the text again.
Ablations count bit patterns first (at most 2**rules rows, map-side combined).

Everything is DataFrame functions; a document is one row all along, so there is
no shuffle and no key that could be hot.

Defined results: null or empty text has no words (rules ``few_words`` fails,
no other); very long texts are handled whole; repeated rows each get their own
equal ledger row; an empty table gives an empty ledger; columns of the input
that clash with the internal names are kept (internal names step aside).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import SPACE, WORD, col, fresh

WINDOW_WORDS = 5
#: Characters counted as symbols (fixed value).
SYMBOLS = "#*$%&|<>"

#: Bit of each rule, in ledger order. A rule is only ever appended, so that
#: stored ledgers stay readable.
RULES = ("few_words", "repeated_windows", "duplicate_lines", "symbols", "word_length", "upper_case")

#: Versioned policies: the rules a document may not fail.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": ("few_words", "repeated_windows", "duplicate_lines", "symbols", "word_length", "upper_case"),
    "v3": ("few_words", "repeated_windows", "symbols", "word_length", "upper_case"),
    "strict": ("few_words", "repeated_windows", "duplicate_lines", "symbols", "word_length", "upper_case"),
}
DEFAULT_POLICY = "v3"


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules."""

    min_words: int = 10
    max_repeat_pct: int = 20       # words in repeated windows, of all words
    max_dup_line_pct: int = 30     # duplicate lines, of lines with a word
    max_symbol_pct: int = 10       # symbols, of all words
    min_word_chars: int = 2        # mean characters a word
    max_word_chars: int = 25
    max_upper_pct: int = 70        # upper-case A-Z, of A-Z and a-z


def bit(rule: str) -> int:
    return 1 << RULES.index(rule)


def policy_mask(rules: tuple[str, ...] | str) -> int:
    names = POLICIES[rules] if isinstance(rules, str) else rules
    return sum({bit(r) for r in names})


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _repeat_words(windows: Column, zipped: Column, n_words: Column) -> Column:
    """Words covered by windows found twice or more. ``zipped`` is the sorted
    array of (window hash, position), null when no window is repeated."""
    repeated = F.array_sort(F.array_compact(F.transform(
        zipped,
        lambda x, k: F.when((F.get(zipped, k - 1)["h"] == x["h"]) | (F.get(zipped, k + 1)["h"] == x["h"]), x["i"]),
    )))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    covered = F.aggregate(
        repeated, start,
        lambda a, p: F.struct((a["n"] + (p + WINDOW_WORDS - F.greatest(p, a["to"]))).cast("long").alias("n"),
                              (p + WINDOW_WORDS).cast("int").alias("to")),
        lambda a: a["n"])
    return F.coalesce(covered, F.lit(0).cast("long"))


def ledger(docs: DataFrame, text_col: str = "text", out_col: str = "ledger",
           limits: Limits = Limits()) -> DataFrame:
    """``docs`` plus the struct ``out_col``: n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, n_letters, n_upper (long each) and
    ``failed`` (long, one bit a rule)."""
    w, h, z, m, t = fresh(docs, "__words", "__windows", "__zipped", "__measures", "__text")
    keep = [col(c) for c in docs.columns]
    text = col(t)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    n = F.size(col(w))
    step = docs.withColumn(t, F.coalesce(col(text_col), F.lit("")))
    step = step.withColumn(w, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    step = step.withColumn(h, F.when(n >= WINDOW_WORDS, F.transform(
        F.sequence(F.lit(1), n - (WINDOW_WORDS - 1)),
        lambda i: F.xxhash64(F.slice(col(w), i, WINDOW_WORDS)))))
    step = step.withColumn(z, F.when(
        F.size(F.array_distinct(col(h))) < F.size(col(h)),
        F.array_sort(F.transform(col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    step = step.withColumn(m, F.struct(
        n.cast("long").alias("n_words"),
        _length_without(text, SPACE).alias("word_chars"),
        _length_without(text, f"[^{SYMBOLS}]+").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(col(h), col(z), n).alias("n_repeat_words"),
        _length_without(text, "[^A-Za-z]+").alias("n_letters"),
        _length_without(text, "[^A-Z]+").alias("n_upper"),
    ))
    x = {f: col(m)[f] for f in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                                "n_repeat_words", "n_letters", "n_upper")}
    fails = {
        "few_words": x["n_words"] < limits.min_words,
        "repeated_windows": x["n_repeat_words"] * 100 > x["n_words"] * limits.max_repeat_pct,
        "duplicate_lines": x["n_dup_lines"] * 100 > x["n_lines"] * limits.max_dup_line_pct,
        "symbols": x["n_symbols"] * 100 > x["n_words"] * limits.max_symbol_pct,
        "word_length": (x["word_chars"] < x["n_words"] * limits.min_word_chars)
                       | (x["word_chars"] > x["n_words"] * limits.max_word_chars),
        "upper_case": x["n_upper"] * 100 > x["n_letters"] * limits.max_upper_pct,
    }
    failed = F.lit(0).cast("long")
    for rule in RULES:
        failed = failed.bitwiseOR(F.when(fails[rule], F.lit(bit(rule))).otherwise(0).cast("long"))
    return step.select(*keep, F.struct(*[v.alias(k) for k, v in x.items()], failed.alias("failed")).alias(out_col))


def passing(docs: DataFrame, policy: tuple[str, ...] | str = DEFAULT_POLICY) -> DataFrame:
    """The rows of ``docs`` that the policy keeps. The optimizer would move the
    filter below the measurements and evaluate them anew for each use; a column
    that is not a function of the row holds it above them."""
    name, number = fresh(docs, "__ledger", "__number")
    rows = ledger(docs, out_col=name).withColumn(number, F.monotonically_increasing_id())
    good = ~fails_policy(col(name)["failed"], policy) & (col(number) >= 0)
    return rows.where(good).select(*[col(c) for c in docs.columns])


def fails_policy(failed: Column, policy: tuple[str, ...] | str) -> Column:
    """True if a rule of the policy failed."""
    return failed.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) != 0


def ablations(rows: DataFrame, failed: Column, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: documents, documents the policy
    rejects, those the rule fails, and those only this rule rejects (they would
    come back without it). One shuffle, of bit patterns with counts."""
    patterns = rows.groupBy(failed.alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    grid = F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(policy_mask(p if p in POLICIES else r)).cast("long").alias("mask"),
                 F.lit(x).alias("rule"), F.lit(bit(x)).cast("long").alias("bit"))
        for p, r in policies.items() for x in r])
    each = patterns.select("failed", "n", F.explode(grid).alias("g")).select("failed", "n", "g.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")

    return each.groupBy("policy", "rule").agg(
        F.sum("n").cast("long").alias("n_docs"), total(hit != 0).alias("n_rejected"),
        total(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_rule_fails"),
        total(hit == F.col("bit")).alias("n_only_this_rule"))


def quality_rules(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Result of the registered query: the measurements, whether the base
    policy fails, the whole bit mask, and whether ``policy`` keeps the row."""
    rows = ledger(docs.select(col("doc_id"), col("text")), out_col="ledger")
    v = F.col("ledger")
    base = fails_policy(v["failed"], "base")
    return rows.select(
        "doc_id", v["n_words"].alias("n_words"), v["word_chars"].alias("word_chars"),
        v["n_symbols"].alias("n_symbols"), v["n_dup_lines"].alias("n_dup_lines"),
        v["n_repeat_words"].alias("n_repeat_words"), base.alias("base_failed"),
        (~base & ~fails_policy(v["failed"], policy)).alias("kept"), v["failed"].alias("failed"))


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(text, '[^A-Za-z]+', '', 'g')) AS n_letters,
             length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
                 + CASE WHEN n_repeat_words * 100 > n_words * 20 THEN 2 ELSE 0 END
                 + CASE WHEN n_dup_lines * 100 > n_lines * 30 THEN 4 ELSE 0 END
                 + CASE WHEN n_symbols * 100 > n_words * 10 THEN 8 ELSE 0 END
                 + CASE WHEN word_chars < n_words * 2 OR word_chars > n_words * 25 THEN 16 ELSE 0 END
                 + CASE WHEN n_upper * 100 > n_letters * 70 THEN 32 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, (failed & 59) = 0 AS kept, failed FROM b
"""
