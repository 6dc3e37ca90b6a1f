"""Rule bitmask ledger: every quality rule is evaluated once per document.

``ledger`` measures each text with JVM-side expressions only, evaluates all rules and
stores one bit per failed rule beside the measurements.  Policies are versioned
sets of rules; applying one is a mask test, and ablations (what a rule removes, alone
or at all) are bit operations summed over the ledger.  No text is read again.

Null and empty texts have no words: all measurements are 0 and ``few_words`` fails.
Repeated rows get a row each.  Extra columns are not carried.  Everything is linear or
n log n in a text's length; only the words of one text are held at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

WINDOW = 5
WHITE = r"[\\x20\\x09-\\x0D]+"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")

# The rules in bit order: name and the failing condition over the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * word_chars"),
    ("duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("long_words", "word_chars > 30 * n_words"),
    ("short_words", "word_chars < n_words + n_words div 4"),
    ("shouting", "100 * n_upper > 50 * word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICY_V1 = Policy("v1", BASE.rules + ("symbols", "duplicate_lines"))
POLICY_V2 = Policy("v2", POLICY_V1.rules + ("long_words", "short_words", "shouting"))
CURRENT = POLICY_V2


def measure(docs: DataFrame) -> DataFrame:
    """The input row as ``row`` and the measurements of its whole text."""
    window = ", ".join(f"wh[i + {k}]" if k else "wh[i]" for k in range(WINDOW))
    steps = [
        {"t": "coalesce(text, '')"},
        {
            "w": f"array_remove(split(t, '{WHITE}'), '')",
            "lines": "filter(split(t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')",
        },
        {"wh": "transform(w, x -> xxhash64(x))", "n": "size(w)"},
        {
            "win": f"""if(n >= {WINDOW},
                       transform(sequence(0, n - {WINDOW}), i -> xxhash64({window})),
                       cast(array() as array<bigint>))"""
        },
        {"twice": "size(array_distinct(win)) < size(win)"},
        # only texts with a repeated window are sorted: equal hashes become neighbours
        {"s": "case when twice then sort_array(transform(win, (h, i) -> struct(h, i))) end"},
        {
            "pos": """case when twice then sort_array(transform(filter(s, (x, k) ->
                          (k > 0 and s[greatest(k - 1, 0)].h = x.h) or
                          (k + 1 < size(s) and s[least(k + 1, size(s) - 1)].h = x.h)), x -> x.i)) end"""
        },
        {
            "n_words": "cast(n as bigint)",
            "word_chars": "aggregate(w, 0L, (a, x) -> a + char_length(x))",
            "n_symbols": "cast(regexp_count(t, '[#*$%&|<>]') as bigint)",
            "n_lines": "cast(size(lines) as bigint)",
            "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
            # words covered: each repeated window adds what the next one does not cover
            "n_repeat_words": f"""case when twice then aggregate(sequence(0, size(pos) - 1), 0L, (a, k) ->
                          a + if(k + 1 < size(pos),
                                 least({WINDOW}, pos[least(k + 1, size(pos) - 1)] - pos[k]), {WINDOW}))
                          else 0L end""",
            "n_upper": "cast(char_length(t) - char_length(regexp_replace(t, '\\\\p{Lu}+', '')) as bigint)",
        },
    ]
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    for step in steps:
        out = out.withColumns({name: F.expr(sql) for name, sql in step.items()})
    # a generator of one row: a filter on the measurements is not pushed below it, where the
    # optimizer would write out (and evaluate) their definitions again for every use
    return out.select("row", F.inline(F.array(F.struct(*MEASURES))))


def failed_bits() -> Column:
    bits = [
        F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long")
        for name, condition in RULES
    ]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed`` (a bit for every failed rule)."""
    ids = docs.select("doc_id", "text")
    return measure(ids).select("row.doc_id", *MEASURES, failed_bits().alias("failed"))


def fails(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` by this policy."""
    return rows.withColumn("policy", F.lit(policy.version)).withColumn("kept", ~fails(policy))


def kept_documents(docs: DataFrame, policy: Policy) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the policy keeps."""
    return measure(docs).withColumn("failed", failed_bits()).filter(~fails(policy)).select("row.*")


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents it fails, fails alone, and kept if it were dropped."""
    masked = F.col("failed").bitwiseAND(F.lit(policy.mask))
    counts = rows.groupBy(masked.alias("failed")).agg(F.count("*").alias("n"))  # <= 2^rules rows
    rule = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).alias("bit")) for n in policy.rules)))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("failed").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return (
        counts.select("failed", "n", rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            total(hit).alias("n_failed"),
            total(hit & rest).alias("n_failed_alone"),
            total(rest).alias("n_kept_without"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: measurements, failed rules and verdict of every document."""
    rows = apply_policy(ledger(read(spark, sf_dir, "documents")), CURRENT)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        fails(BASE).alias("base_failed"),
        "kept",
        F.col("failed").alias("failed_rules"),
    )


def _duck(condition: str) -> str:
    return condition.replace(" div ", " // ")


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         [l for l in string_split(coalesce(text, ''), chr(10))
          if regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}) x
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) x WHERE c > 1
), covered AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM (
    SELECT DISTINCT doc_id, i + k AS p
    FROM (SELECT doc_id, i, unnest(range(0, {WINDOW})) AS k FROM twice) y) z
  GROUP BY doc_id
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum([length(x) for x in w]), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(regexp_extract_all(t, '\\p{{Lu}}')) AS BIGINT) AS n_upper
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
), f AS (
  SELECT *, CAST({" + ".join(f"CASE WHEN {_duck(c)} THEN {BIT[n]} ELSE 0 END" for n, c in RULES)} AS BIGINT)
         AS failed_rules
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_rules & {BASE.mask}) <> 0 AS base_failed,
       (failed_rules & {CURRENT.mask}) = 0 AS kept, failed_rules
FROM f
"""
