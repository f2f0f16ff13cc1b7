"""Quality rules: a threshold table compiled into one Spark projection (DataFrame functions only).

``RULES`` is the table: each row bounds one count of a text by another one,
``low * per <= 1000 * value <= high * per``. ``compile_rules`` turns any such
table into one boolean column, so all rules of a text are judged in the
projection that counts it: no join, no shuffle, no user function, and every
text is read once, whole.

The counts come from built-in array functions over the words
(``[^\\x20\\x09-\\x0D]+``) and lines of a text. Words of repeated passages are
those covered by a 3-word window that the text holds twice or more: windows
are compared as text (words hold no blanks, so joined windows are equal only
if their words are); only texts whose windows are not all distinct sort them.

Defined results: null text counts as empty and has no words; an empty or
blank text has zero counts and fails the base rules. Very long texts are
worked on whole, in memory in proportion to the text. Repeated rows and null
ids are judged like any other row; an empty table gives an empty result.
``judged`` passes extra columns through, whatever their names, in ``row``;
``decisions`` reads only id and text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import text_or_empty

BLANKS = "[ \\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50  # of 100 words

# Very frequent words of the languages that the rules know.
STOP_WORDS = {
    "de": ("der", "die", "das", "und", "in", "den", "von", "zu", "mit", "ein", "eine", "ist", "im", "für", "auf"),
    "en": ("the", "and", "of", "to", "in", "a", "is", "that", "for", "with", "on", "was", "as", "by", "this"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "una", "es"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "dans", "que", "par", "pour", "est"),
}


@dataclass(frozen=True)
class Rule:
    """Bounds of count ``value`` in thousandths of count ``per`` (None: no bound)."""

    value: str
    per: str
    low: int | None = None
    high: int | None = None


#: The threshold table. A letter count per word, marks and capitals of other
#: than prose, words that every prose has, and lines that repeat or are no
#: sentences.
RULES = (
    Rule("word_chars", "n_words", low=2_000, high=12_000),
    Rule("n_symbols", "n_words", high=100),
    Rule("n_capitals", "word_chars", high=400),
    Rule("n_stop_words", "n_words", low=10),
    Rule("n_letter_words", "n_words", low=700),
    Rule("n_dup_lines", "n_lines", high=500),
    Rule("n_bullet_lines", "n_lines", high=900),
    Rule("n_ellipsis_lines", "n_lines", high=300),
)


def rules_from(table: DataFrame, most: int = 1_000) -> tuple[Rule, ...]:
    """The rows (value, per, low, high) of a threshold table; raises beyond ``most`` rows."""
    rows = table.select("value", "per", "low", "high").orderBy("value", "per", "low", "high").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a threshold table has at most {most} rows")
    return tuple(Rule(*r) for r in rows)


def compile_rules(rules: Iterable[Rule], count: Callable[[str], Column] = F.col) -> Column:
    """One column: true if every rule holds (a rule ``per`` a zero count asks for a zero value)."""
    out = F.lit(True)
    for r in rules:
        value, per = count(r.value) * 1000, count(r.per)
        if r.low is not None:
            out = out & (value >= per * r.low)
        if r.high is not None:
            out = out & (value <= per * r.high)
    return out


def rules_sql(rules: Iterable[Rule]) -> str:
    """The same condition as SQL text."""
    parts = [f"1000 * {r.value} >= {r.low} * {r.per}" for r in rules if r.low is not None]
    parts += [f"1000 * {r.value} <= {r.high} * {r.per}" for r in rules if r.high is not None]
    return " AND ".join(parts) or "true"


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` worked out once, however often ``f`` or a lambda in it reads it."""
    return F.get(F.transform(F.array(value), lambda x: f(x)), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def windows(w: Column, size: int = WINDOW) -> Column:
    """Every window of ``size`` words, joined by a blank."""
    starts = F.sequence(F.lit(0), F.size(w) - size)
    joined = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]))
    return F.when(F.size(w) >= size, joined).otherwise(F.array().cast("array<string>"))


def _repeated_starts(wins: Column) -> Column:
    """Sorted starts of the windows that occur twice or more."""

    def of_sorted(s: Column) -> Column:
        def start(e: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1), F.get(s, k + 1)
            same = (F.coalesce(before["w"] == e["w"], F.lit(False))) | (F.coalesce(after["w"] == e["w"], F.lit(False)))
            return F.when(same, e["i"])

        return F.sort_array(F.array_compact(F.transform(s, start)))

    return _once(F.sort_array(F.transform(wins, lambda x, i: F.struct(x.alias("w"), i.alias("i")))), of_sorted)


def _covered(starts: Column, size: int = WINDOW) -> Column:
    """Words covered by windows of ``size`` words at the sorted ``starts``."""
    steps = F.transform(starts, lambda x, k: F.when(k == 0, size).otherwise(F.least(F.lit(size), x - F.get(starts, k - 1))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def repeat_words(w: Column) -> Column:
    """Words in windows that the text holds twice or more, the first one included."""
    return _once(
        windows(w),
        lambda wins: F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0)).otherwise(_once(_repeated_starts(wins), _covered)),
    )


def _count(values: Column, keep: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(values, keep))


def _chars(text: Column, letters: str) -> Column:
    """Characters of ``text`` in the class ``letters``."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{letters}]+", ""))


def _counts_of_words(w: Column) -> Column:
    stop = sorted({s for v in STOP_WORDS.values() for s in v})
    plain = lambda x: F.lower(F.rtrim(x, F.lit(".,;:!?")))
    return F.struct(
        F.size(w).alias("n_words"),
        _count(w, lambda x: plain(x).isin(stop)).alias("n_stop_words"),
        _count(w, lambda x: x.rlike("\\p{L}")).alias("n_letter_words"),
        repeat_words(w).alias("n_repeat_words"),
    )


def _counts_of_lines(lines: Column) -> Column:
    return F.struct(
        F.size(lines).alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        _count(lines, lambda x: F.substring(x, 1, 1).isin("-", "*", "•")).alias("n_bullet_lines"),
        _count(lines, lambda x: x.endswith("...") | x.endswith("…")).alias("n_ellipsis_lines"),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_letter_words", "n_capitals", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def judged(docs: DataFrame, rules: Iterable[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """(row, the counts, base_failed, kept) for every row of ``docs``."""
    text = text_or_empty(F.col(f"`{text_col}`"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    counted = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        _once(words(text), _counts_of_words).alias("w"),
        _once(lines, _counts_of_lines).alias("l"),
        F.length(F.regexp_replace(text, BLANKS, "")).alias("word_chars"),
        _chars(text, SYMBOLS).alias("n_symbols"),
        _chars(text, "A-ZÀ-ÖØ-Þ").alias("n_capitals"),
    )
    flat = counted.select("row", "w.*", "l.*", "word_chars", "n_symbols", "n_capitals")
    counts = flat.select("row", *[F.col(c).cast("long").alias(c) for c in COUNTS])
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counts.withColumn("base_failed", base).withColumn("kept", ~base & compile_rules(rules))


def decisions(docs: DataFrame, rules: Iterable[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the counts, base_failed, kept."""
    out = judged(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), rules)
    return out.select(F.col("row.id").alias(id_col), *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, rules: Iterable[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that fail, all columns."""
    kept = judged(docs, rules, text_col).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def oracle_sql(rules: Iterable[Rule] = RULES) -> str:
    """``decisions`` of the table ``documents`` as DuckDB SQL."""
    stop = ", ".join(f"'{s}'" for s in sorted({s for v in STOP_WORDS.values() for s in v}))
    blanks = r"[ \x09-\x0D]+"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT *, list_filter(string_split_regex(t, '{blanks}'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS l FROM d
), g AS (
  SELECT k, i, list_aggregate(list_slice(w, i, i + {WINDOW - 1}), 'string_agg', ' ') AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM s)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g) WHERE c > 1
), r AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY k
), c AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{blanks}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[{SYMBOLS}]+', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: lower(rtrim(x, '.,;:!?')) IN ({stop}))) AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]+', '', 'g')) AS n_capitals,
    len(l) AS n_lines,
    len(list_filter(l, lambda x: x[1] IN ('-', '*', '•'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ellipsis_lines
  FROM s LEFT JOIN r USING (k)
), b AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c
)
SELECT doc_id, {", ".join(f"{c}::BIGINT AS {c}" for c in COUNTS)}, base_failed, NOT base_failed AND {rules_sql(rules)} AS kept FROM b"""
